from __future__ import annotations

import ipaddress
import json

import pytest
from pyspark.sql import functions as F

from siltwatch.functions import rules as R
from siltwatch.functions.network import is_ip, is_ipv4, is_ipv6, subnet_id, subnet_v4, subnet_v6
from siltwatch.operators import filtering
from siltwatch.operators import validation as V

SPEC = [
    ["ts", "Timestamp", "%Y-%m-%dT%H:%M:%S"],
    ["src_ip", "IpAddress"],
    ["status", "ListItem", ["200", "300", "404"], ["200", "404"]],
    ["size", "RegEx", r"\d+"],
]


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


@pytest.mark.parametrize(
    "entries",
    [
        [],
        [["ts"]],
        [[1, "RegEx", "x"]],
        [["a", "Unknown"]],
        [["a", "RegEx"]],
        [["a", "RegEx", 3]],
        [["a", "Timestamp"]],
        [["a", "IpAddress", "x"]],
        [["a", "ListItem", "x"]],
        [["a", "ListItem", ["x"], ["y"]]],
        [["a", "ListItem", ["x"], ["x"], ["x"]]],
        [*SPEC, ["ts", "RegEx", "x"]],
        [*SPEC, ["logline_id", "RegEx", "x"]],
        [*SPEC, ["batch_id", "RegEx", "x"]],
        SPEC[:1],
        SPEC[1:],
    ],
)
def test_bad_formats_are_rejected(entries):
    with pytest.raises(ValueError):
        R.LogFormat.parse(entries)


def test_optional_relevant_list():
    assert R.rule_from_entry(["a", "ListItem", ["x"], None]).relevant is None
    assert R.rule_from_entry(["a", "ListItem", ["x", "y"], ["y"]]).relevant == ("y",)


def test_regex_is_anchored_at_the_start_only(spark):
    rule = R.rule_from_entry(["a", "RegEx", r"\d+|x"])
    assert column(spark, ["12", "12b", "a12", "x", None], rule.test) == [True, True, False, True, False]


def test_timestamp_formats(spark):
    rule = R.rule_from_entry(["ts", "Timestamp", "%Y-%m-%dT%H:%M:%S.%fZ"])
    values = ["2024-05-21T08:31:28.1Z", "2024-05-21T08:31:28.119123Z", "2024-05-21 08:31:28.119Z", "2024-13-21T08:31:28.1Z", None]
    assert column(spark, values, rule.test) == [True, True, False, False, False]
    with pytest.raises(ValueError):
        R.spark_time_pattern("%Q")


ADDRESSES = [
    "192.168.0.1", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4.5", "", "::", "::1", "1::", "2001:db8::1", "2001:db8:0:0:0:0:0:1",
    "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4",
    "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.256", "12345::", "fe80::1%eth0", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8",
    "1:2:3:4::5:6:7:8", "g::1", "1.2.3.4:80", "::1:2:3:4:5:6:1.2.3.4", "::2:3:4:5:6:1.2.3.4", "1:2:3:4:5::1.2.3.4",
]


def known(text, kind):
    try:
        return isinstance(ipaddress.ip_address(text), kind)
    except ValueError:
        return False


def test_addresses_match_the_standard_library(spark):
    v4, v6 = ipaddress.IPv4Address, ipaddress.IPv6Address
    assert column(spark, ADDRESSES, is_ipv4) == [known(a, v4) for a in ADDRESSES]
    assert column(spark, ADDRESSES, is_ipv6) == [known(a, v6) for a in ADDRESSES]
    assert column(spark, [None], is_ip) == [False]


@pytest.mark.parametrize("prefix", [0, 1, 7, 8, 12, 16, 20, 23, 24, 25, 31, 32])
def test_ipv4_subnets(spark, prefix):
    addresses = ["192.168.171.77", "10.0.0.1", "255.255.255.255", "0.0.0.0"]
    want = [f"{ipaddress.ip_network((a, prefix), strict=False).network_address}_{prefix}" for a in addresses]
    assert column(spark, [*addresses, "::1", None], lambda c: subnet_v4(c, prefix)) == [*want, None, None]


@pytest.mark.parametrize("prefix", [0, 20, 64, 96, 128])
def test_ipv6_subnets_match_address_arithmetic(spark, prefix):
    addresses = ["2001:DB8:85a3:1234:5678:8a2e:0370:7334", "::1", "::", "1::", "1:0:0:2:0:0:0:3", "0:0:1:0:0:1:0:0", "fe80::10:0:0:1%eth0", "64:ff9b::192.0.2.33", "10:0:20:0:30:0:40:0"]
    got = column(spark, addresses, lambda c: subnet_v6(c, prefix))
    want = [ipaddress.IPv6Network((a.split("%")[0], prefix), strict=False).network_address for a in addresses]
    assert got == [f"{w}_{prefix}" for w in want]


def test_ipv6_subnets_need_no_python(spark):
    df = spark.createDataFrame([("::1",)], "a string").select(subnet_id(F.col("a")))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_ipv6_subnets(spark):
    got = column(spark, ["2001:db8:85a3:1234:5678:8a2e:0370:7334", "::1", "1.2.3.4", None], lambda c: subnet_v6(c, 64))
    assert got == ["2001:db8:85a3:1234::_64", "::_64", None, None]
    assert column(spark, ["1.2.3.4", "2001:db8::1"], subnet_id) == ["1.2.3.0_24", "2001:db8::_64"]


@pytest.mark.parametrize("fn,prefix", [(subnet_v4, -1), (subnet_v4, 33), (subnet_v6, -1), (subnet_v6, 129)])
def test_bad_prefixes(spark, fn, prefix):
    with pytest.raises(ValueError):
        fn(F.lit("x"), prefix)


def line(**change):
    row = {"ts": "2024-05-21T08:31:28", "src_ip": "1.2.3.4", "status": "200", "size": "12", "extra": "e"}
    row.update(change)
    return json.dumps({k: v for k, v in row.items() if v is not None})


def test_lines_split_into_valid_and_failed(spark):
    fmt = R.LogFormat.parse(SPEC)
    raws = [line(), line(size=12), line(status="500"), line(ts=None), line(src_ip="x", size="b"), "nonsense", "[1]", "{}", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    failed = {r.i: r.reason_for_failure for r in V.failed_lines(V.parse_lines(df, fmt)).collect()}
    valid = {r.i for r in V.valid_lines(df, fmt).collect()}
    assert valid == {0, 1}
    assert failed == {2: "status", 3: "ts", 4: "src_ip,size", 5: "json", 6: "json", 7: "ts,src_ip,status,size", 8: "json"}
    assert valid | set(failed) == set(range(len(raws)))


def test_unknown_fields_survive(spark):
    df = spark.createDataFrame([(line(),)], "raw string")
    got = json.loads(df.select(V.additional_fields(F.col("raw"))).first()[0])
    assert got == {"status": "200", "size": "12", "extra": "e"}


def test_message_ids_only_from_uuids(spark):
    rows = [("0b0F1d6e-1111-4222-8333-444455556666", "t", 0, 1), ("nope", "t", 0, 2), (None, "t", 0, 3)]
    df = spark.createDataFrame(rows, "key string, topic string, partition int, offset bigint")
    first, again = (V.with_message_ids(df).orderBy("offset").collect() for _ in range(2))
    assert [r.server_message_id for r in first] == ["0b0f1d6e-1111-4222-8333-444455556666", None, None]
    assert [r.logline_id for r in first] == [r.logline_id for r in again]
    assert len({r.logline_id for r in first}) == 3


def test_relevance_methods(spark):
    fmt = R.LogFormat.parse(SPEC)
    df = spark.createDataFrame([("200",), ("300",), ("404",), (None,)], "status string")
    assert {r.status for r in filtering.keep_relevant(df, "check_dga_relevance", fmt).collect()} == {"200", "404"}
    assert filtering.keep_relevant(df, "no_relevance_check", fmt).count() == 4
    with pytest.raises(ValueError):
        filtering.keep_relevant(df, "absent", fmt)

    @R.relevance("only_300")
    def only_300(_):
        return F.col("status") == "300"

    assert filtering.keep_relevant(df, "only_300", fmt).count() == 1
