"""Personal data, line removal and licences against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from siltwatch.llm import licenses, line_dedup, pii
from tests.llm.cases import awkward, frame, prose

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def base_spans(text: str) -> tuple[list[int], str]:
    counts, found = [], []
    for k, (kind, pattern) in enumerate(BASE):
        own = [m for m in re.finditer(pattern, text) if passes(kind, m.group())]
        counts.append(len(own))
        found += [(m.start(), k, m.end()) for m in own]
    return counts, ",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in sorted(found))


def pii_texts() -> list[str | None]:
    rng = random.Random(12)
    parts = ["a@b.c", "x.y+z@mail-1.example.com", "a@b.c_d@e.f", "@", "4539 1488 0343 6467", "4539-1488-0343-6467", "1 2  3", "+1 (788) 555-2942", "+12", "+1 2", "++49 30 1234567",
             "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.003.0004", "1.2.3", "é日", "12345678901234567890123", "0000000000000000", "at", "12:34:56:78", "😀"]
    fuzz = ["".join(rng.choice("01 2.-+@a()9 5") for _ in range(80)) for _ in range(120)]
    mixed = [" ".join(rng.choice(parts) for _ in range(8)) for _ in range(60)] + ["".join(rng.choice(parts) for _ in range(5)) for _ in range(60)]
    return [*parts, *fuzz, *mixed, None, "", "9" * 50_000, "a" * 50_000, "a.b@" + "c." * 20_000]


def test_base_spans(spark):
    data = [(i, t, "", "", "", "", "", "") for i, t in enumerate(pii_texts())]
    got = {r.doc_id: r for r in pii.digest(pii.personal_data(frame(spark, data))).collect()}
    for i, text, *_ in data:
        counts, spans = base_spans(text or "")
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, text
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), text
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))


def test_pii_without_anything_to_learn(spark):
    assert pii.personal_data(frame(spark, [])).count() == 0
    assert {r.spans for r in pii.digest(pii.personal_data(frame(spark, awkward()))).collect()} == {""}


def disguised(rng, i):
    """A text with a plain span, one with a disguised span, or one with something else, and what should be added."""
    name, host = f"{prose(rng, 1)}.{rng.randrange(100)}", f"mail{rng.randrange(9)}.example.com"
    area, line = rng.randrange(100, 999), rng.randrange(1000, 9999)
    if i % 2:
        lead, plain = "write a mail to ", f"{name}@{host}"
        hidden = rng.choice([f"{name} (at) {host}", f"{name} [at] {host}", f"{name} at mail dot example dot com"])
        other = f"look at figure.{rng.choice(['seven', 'three'])}"
    else:
        lead, plain = "call my phone ", f"+1 ({area}) 555-{line}"
        hidden = rng.choice([f"1 ({area}) 555-{line}", f"001 ({area}) 555-{line}", f"1.{area}.555.{line}"])
        other = f"part no {area}-{line}"
    kind = i % 6 // 2
    value = (plain, hidden, other)[kind] if kind < 2 else other
    head = f"{prose(rng, 6)} {lead if kind < 2 else ''}"
    return head + value + f" {prose(rng, 5)}", kind, (len(head), 0 if i % 2 else 3, len(head) + len(value))


def test_trees_add_disguised_spans(spark):
    rng = random.Random(13)
    made = [disguised(rng, i) for i in range(900)]
    data = [(i, text, "", "", "", "", "", "") for i, (text, _, _) in enumerate(made)]
    found = {r.doc_id: r for r in pii.personal_data(frame(spark, data)).collect()}
    hidden = right = added = 0
    for i, (_, kind, span) in enumerate(made):
        base, spans = ({tuple(s) for s in found[i][c]} for c in ("base", "spans"))
        assert base <= spans and base == ({span} if kind == 0 else set())
        more = spans - base
        added += len(more)
        hidden += kind == 1
        right += kind == 1 and span in more
    assert right >= 0.9 * hidden and right >= 0.95 * added


def test_trees_learn_from_every_labelled_candidate(spark, monkeypatch):
    """30,000 addresses, half of which no host can have, all take part in the fit or in the thresholds."""
    seen = {}

    class Noted(pii.GBTClassifier):
        def fit(self, rows, params=None):
            seen["fit"] = rows.select("mark").distinct().count()
            return super().fit(rows, params)

    monkeypatch.setattr(pii, "GBTClassifier", Noted)
    value = F.concat(F.lit("10.0.0."), (F.col("id") % 500).cast("string"))
    span = F.struct(F.lit(0).alias("start"), F.lit(1).alias("kind"), F.length(value).alias("end"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = spark.range(30_000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 500 < 256, F.array(span)).otherwise(none).alias("base"),
        span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"), value.alias("value"),
        F.lit("host ").alias("before"), F.lit("").alias("after"),
    )
    assert pii.added_spans(rows, pii.PiiSpec(trees=1, depth=1)) is not None
    assert seen["fit"] == rows.where(F.pmod(F.xxhash64("row", "start", "kind", "end"), F.lit(3)) != 0).count()


@pytest.mark.parametrize("most", [1, 30])
def test_spread_lines(spark, most):
    rng = random.Random(14)
    common = [prose(rng, 9) for _ in range(4)]
    data = [r[:1] + r[1:3] + r[3:] for r in awkward()]
    for i in range(most * 12):
        own = [prose(rng, 6), common[i % 4 if i % 3 else 0], "", prose(rng, 4)]
        data.append((300 + i, "\n".join(own), "en", f"site{i % 13}", "", "", "", ""))
    data.append(data[-1])
    sites: dict[str, set] = {}
    for r in data:
        for line in (r[1] or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                sites.setdefault(line, set()).add(r[3])
    want = []
    for r in data:
        lines = (r[1] or "").split("\n")
        rest = [x for x in lines if len(sites.get(x, ())) < 10]
        want.append((r[0], len(lines), len(lines) - len(rest), hashlib.sha256("\n".join(rest).encode()).hexdigest()))
    got = line_dedup.digest(line_dedup.without_spread_lines(frame(spark, data))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert line_dedup.without_spread_lines(frame(spark, [])).count() == 0


def test_licences(spark):
    rng = random.Random(15)
    mit = licenses.TEMPLATES["MIT"][2]
    texts = [prose(rng, 20) + "\nReleased under  the MIT license!\n" + prose(rng, 9), mit, mit.replace("persons", "people"), mit[:200], "This work is licensed under the GNU General Public License, version 3.", None, "", "MIT"]
    data = [(i, t, "", "", "", "", "", "") for i, t in enumerate(texts)]
    got = {(r.doc_id, r.level, r.licence): r for r in licenses.licences(frame(spark, [*data, data[0]])).collect()}
    assert set(got) == {(0, "line", "MIT"), (1, "line", "MIT"), (2, "line", "MIT"), (4, "line", "GPL-3.0")}
    a, b = licenses.plain_bigrams(texts[2]), licenses.plain_bigrams(mit)
    assert got[2, "line", "MIT"].dice == pytest.approx(2 * len(a & b) / (len(a) + len(b)))
    assert licenses.licences(frame(spark, [])).count() == 0


def test_wrapped_licences(spark):
    rng = random.Random(17)
    gpl, mpl, mit, apache = licenses.TEMPLATES["GPL-3.0"][1], licenses.TEMPLATES["MPL-2.0"][0], licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["Apache-2.0"][1]
    wrap = lambda text, lead: "\n".join(lead + x for x in textwrap.wrap(text, 60))
    code = "\n\nimport os\n" + "\n".join(f"x{i} = os.path.join('{prose(rng, 4)}')" for i in range(80))
    notices = [wrap(gpl, " * ") + code, "MIT License\n\nCopyright (c) 2020\n\n" + wrap(mit, "") + "\n\nTHE SOFTWARE IS PROVIDED " + prose(rng, 90), prose(rng, 60) + " " + mpl + " " + prose(rng, 60), wrap(apache, "# ") + code,
               code + "\n" + wrap(gpl, "// ") + code + wrap(mit, "# "), code, prose(rng, 300), gpl + code]
    got = licenses.licences(frame(spark, [(i, x, "", "", "", "", "", "") for i, x in enumerate(notices)])).collect()
    long = {(r.doc_id, r.level, r.licence) for r in got if r.template_bigrams > 15}
    assert long == {(0, "run", "GPL-3.0"), (1, "run", "MIT"), (2, "run", "MPL-2.0"), (3, "run", "Apache-2.0"), (4, "run", "GPL-3.0"), (4, "run", "MIT"), (7, "line", "GPL-3.0")}
    assert [r for r in got if r.template_bigrams > 15 and r.dice < 1] == []
    assert {r.unit for r in got if r.doc_id == 0} == {0}
