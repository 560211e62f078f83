"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random
import re
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, size string, quality_score string, row string"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def fold(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    stems = {"en": "the of and thing water house ring", "de": "der die und nicht wärme straße übung", "fr": "le des été forêt où garçon lui"}[lang].split()
    return " ".join(rng.choice(stems) + rng.choice(["", "s", "er", "en", "a", "on"]) + (rng.choice("bcdfgh") if rng.random() < 0.3 else "") for _ in range(n))


def rows(texts: list[str | None], start: int = 0) -> list[tuple]:
    """Documents with other columns whose names clash with results."""
    return [(start + i, t, "en", f"s{i % 3}", "x", "x", "x", "x") for i, t in enumerate(texts)]


def awkward() -> list[tuple]:
    rng = random.Random(3)
    base = prose(rng, 60)
    texts = [base, base, base.replace(" ", "\t\n", 3), base.upper(), None, "", "  \n ", "one", "one two", prose(rng, 30_000), "日本語のテキスト", base + " extra"]
    own = rows(texts)
    own.append(own[0])  # a repeated row
    own.append((None, base, None, None, None, None, None, None))
    own.append((100, prose(rng, 40), None, None, None, None, None, None))
    return own


def frame(spark, data: list[tuple]):
    return spark.createDataFrame(data, SCHEMA)
