from __future__ import annotations

import json
from collections import Counter

import regex
from pyspark.sql import functions as F

from quire.functions.text import WORD_SEPARATOR_EXPLICIT, java_split, word_tokens
from quire.operators.cdc import cdc_apply, cdc_decode
from quire.operators.stats_json import flatten_statistics
from quire.operators.udfs import split_with_udf
from quire.operators.words import word_count
from quire.sources.files import from_rows
from quire.session import complete_folders, scratch_path
from quire.sources.tables import load
from quire.streaming import jobs as J
from quire.streaming.replica import bucket_of, manifest, replica, replica_batch


def _tokens(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.w for r in df.orderBy("i").select(word_tokens(F.col("t")).alias("w")).collect()]


def test_java_split_edges(spark):
    got = _tokens(spark, ["", "!!!", "!!Hello, World!!", "a  b", "élan vital—déjà"])
    assert got == [[""], [], ["", "hello", "world"], ["a", "b"], ["élan", "vital", "déjà"]]


def test_java_split_plain_pattern(spark):
    df = spark.createDataFrame([("a,b,,",), (",a",)], "s string")
    assert [r.p for r in df.select(java_split(F.col("s"), ",").alias("p")).collect()] == [["a", "b"], ["", "a"]]


def _java_like_split(s: str) -> list[str]:
    if s == "":
        return [""]
    parts = regex.split(WORD_SEPARATOR_EXPLICIT, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_word_count_brute_force(spark, sf_small):
    docs = load(spark, sf_small, "documents")
    got = {r.word: r["count"] for r in word_count(docs, "text").collect()}
    want = Counter()
    for (t,) in docs.select("text").collect():
        want.update(_java_like_split(t.lower()))
    assert got == dict(want)


def test_udf_split(spark):
    out = split_with_udf(from_rows(spark, ["ann,north", "bo,south"]))
    assert sorted(map(tuple, out.collect())) == [("ann", "north"), ("bo", "south")]


def _message(datanodes, zb_nodes, sj_nodes):
    return json.dumps(
        {
            "returndata": {
                "datanodes": datanodes,
                "wdnodes": [{"wdcode": "zb", "nodes": zb_nodes}, {"wdcode": "sj", "nodes": sj_nodes}],
            }
        }
    )


def _node(has, v, zb, sj):
    return {"data": {"hasdata": has, "data": v}, "wds": [{"wdcode": "zb", "valuecode": zb}, {"wdcode": "sj", "valuecode": sj}]}


def test_flatten_statistics_rules(spark):
    zb = [{"code": "A", "cname": "GDP"}, {"code": "A", "cname": "dup"}, {"code": "B", "cname": ""}]
    sj = [{"code": "2018", "cname": "2018年"}]
    nodes = [
        _node(True, 1.5, "A", "2018"),  # kept, first name wins
        _node(False, 2.0, "A", "2018"),  # no data
        _node(True, 3.0, "B", "2018"),  # empty name
        _node(True, 4.0, "C", "2018"),  # code missing from the dictionary
    ]
    msgs = spark.createDataFrame(
        [
            ("x+m=QueryData&dbcode=hgyd&rowcode=zb&dbcode=other", _message(nodes, zb, sj)),
            ("x+dbcode=fsjd", _message(nodes[:1], zb, sj)),
            ("x+dbcode=csnd", _message(nodes[:1], zb, sj)),
        ],
        "key string, value string",
    )
    rows = sorted(map(tuple, flatten_statistics(msgs).collect()), key=lambda r: r[6])
    assert [(r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in rows] == [
        (1.5, "GDP", [], "TODO", "年度", "2018年", "csnd"),
        (1.5, "GDP", [], "TODO", "季度", "2018年", "fsjd"),
        (1.5, "GDP", [], "全国", "月度", "2018年", "hgyd"),
    ]


# A compact change event: the update of row 77.
CDC_KEY = json.dumps({"payload": {"id": 77}})
CDC_VALUE = json.dumps(
    {
        "schema": {"type": "struct"},
        "payload": {
            "before": {"id": 77, "first_name": "Ida", "last_name": "Berg", "email": "ida@example.org"},
            "after": {"id": 77, "first_name": "Ada", "last_name": "Berg", "email": "ida@example.org"},
            "source": {"version": "1.0", "name": "replica-a", "server_id": 40, "ts_sec": 1600000000, "gtid": None,
                       "file": "changes.000017", "pos": 12, "row": 0, "snapshot": None, "thread": 3,
                       "db": "shop", "table": "clients"},
            "op": "u",
            "ts_ms": 1600000000123,
        },
    }
)


def _event(op, id_, after, ts, pos, row=0):
    return (
        json.dumps({"payload": {"id": id_}}),
        json.dumps({"payload": {"before": None, "after": after, "op": op, "ts_ms": ts,
                                "source": {"file": "f.1", "pos": pos, "row": row}}}),
    )


def test_cdc_decode_sample(spark):
    d = cdc_decode(spark.createDataFrame([(CDC_KEY, CDC_VALUE)], "key string, value string")).first()
    assert (d.op, d.id, d.after.first_name, d.before.first_name, d.file, d.pos, d.ts_ms) == ("u", 77, "Ada", "Ida", "changes.000017", 12, 1600000000123)


def test_cdc_ids_beyond_32_bits(spark):
    row = lambda i: {"id": i, "first_name": "n", "last_name": "l", "email": "e"}
    events = [_event("c", i, row(i), 1, i) for i in (3_000_000_000, 3_000_000_001)]
    got = cdc_apply(cdc_decode(spark.createDataFrame(events, "key string, value string")))
    assert sorted(r.id for r in got.collect()) == [3_000_000_000, 3_000_000_001]


def test_replica_over_several_batches(spark):
    """A delete leaves nothing behind, a re-create comes back, a replayed batch
    changes nothing, and only two versions are kept; a batch rewrites the buckets
    of its own keys and no others."""
    row = lambda i, n: {"id": i, "first_name": n, "last_name": "L", "email": "e"}
    decoded = lambda *e: cdc_decode(spark.createDataFrame(list(e), "key string, value string"))
    out = scratch_path(spark, "replica-test")
    step = replica_batch(out, buckets=16)
    kind = "id long, first_name string, last_name string, email string"
    now = lambda: sorted((r.id, r.first_name) for r in replica(spark, out, kind).collect())
    rewritten = lambda v: sorted(b for b, at in manifest(spark, out, v).items() if at == v)
    buckets = {r.i: r.b for r in spark.range(100).select(F.col("id").alias("i"), bucket_of(F.col("id"), 16).alias("b")).collect()}

    step(decoded(*[_event("c", i, row(i, f"n{i}"), 1, i) for i in range(100)]), 0)
    assert rewritten(0) == sorted(set(buckets.values())) and len(rewritten(0)) == 16
    step(decoded(_event("d", 1, None, 2, 300), _event("u", 2, row(2, "B"), 2, 400)), 1)
    assert rewritten(1) == sorted({buckets[1], buckets[2]}) and len(manifest(spark, out, 1)) == 16
    want = {i: f"n{i}" for i in range(100)}
    del want[1]
    want[2] = "B"
    assert now() == sorted(want.items())
    for _ in range(2):  # the second one is a replay
        step(decoded(_event("c", 1, row(1, "again"), 3, 500)), 2)
        assert now() == sorted((want | {1: "again"}).items()) and rewritten(2) == [buckets[1]]
    assert complete_folders(spark, f"{out}/manifest", "v=") == [1, 2]
    # a superseded bucket is gone, one that is still named is not
    gone = set(complete_folders(spark, f"{out}/data/v=0", "bucket=", mark=None))
    assert gone == set(range(16)) - {buckets[1], buckets[2]}
    step(decoded(*[_event("d", i, None, 9, 1000 + i) for i in range(100)]), 3)
    assert now() == [] and manifest(spark, out, 3) == {}
    step(decoded(), 4)
    assert now() == []


def test_change_order_of_file_names(spark):
    """The last file has more figures than the one before."""
    row = {"id": 1, "first_name": "n", "last_name": "L", "email": "e"}
    event = lambda file, name: (json.dumps({"payload": {"id": 1}}), json.dumps({"payload": {"after": row | {"first_name": name}, "op": "u", "ts_ms": 5, "source": {"file": file, "pos": 1, "row": 0}}}))
    events = [event("log.999999", "old"), event("log.1000000", "new"), event("log.999998", "older")]
    assert cdc_apply(cdc_decode(spark.createDataFrame(events, "key string, value string"))).first().first_name == "new"


def test_fields_of_later_versions_and_no_json(spark):
    value = json.loads(CDC_VALUE)
    value["payload"]["source"]["snapshot"] = "last"
    value["payload"]["transaction"] = {"id": "t-9", "order": 3}
    events = [(CDC_KEY, json.dumps(value)), (CDC_KEY, CDC_VALUE), (CDC_KEY, "{broken"), (None, None)]
    also = {"transaction": ("transaction.id", "string"), "snapshot": ("source.snapshot", "string"), "place": ("transaction.order", "int")}
    got = cdc_decode(spark.createDataFrame(events, "key string, value string"), also=also).collect()
    assert [(r.op, r.id, r.transaction, r.snapshot, r.place) for r in got] == [("u", 77, "t-9", "last", 3), ("u", 77, None, None, None), (None, 77, None, None, None), (None, None, None, None, None)]


def test_documents_are_parsed_once(spark):
    events = spark.createDataFrame([(CDC_KEY, CDC_VALUE)], "key string, value string")
    for df, n in ((cdc_apply(cdc_decode(events)), 2), (flatten_statistics(events), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == n and "from_json" not in plan


def test_first_entry_wins_in_a_large_dictionary(spark):
    """10,000 names, each code given twice, and as many measurements."""
    n = 10_000
    nodes = [{"code": f"c{i % n}", "cname": f"{'first' if i < n else 'second'} {i % n}"} for i in range(2 * n)]
    nodes += [{"code": None, "cname": "none"}]
    data = [{"data": {"hasdata": True, "data": i / 2}, "wds": [{"wdcode": "zb", "valuecode": f"c{i}"}, {"wdcode": "sj", "valuecode": "d1"}]} for i in range(n + 5)]
    days = {"wdcode": "sj", "nodes": [{"code": "d1", "cname": "2020"}, {"code": "d1", "cname": "2021"}]}
    value = json.dumps({"returndata": {"datanodes": data, "wdnodes": [{"wdcode": "zb", "nodes": nodes}, days, {"wdcode": "zb", "nodes": []}]}})
    got = flatten_statistics(spark.createDataFrame([("a+dbcode=hgyd", value)], "key string, value string")).collect()
    assert sorted((r.quotaName, r.value, r.date) for r in got) == sorted((f"first {i}", i / 2, "2020") for i in range(n))


def test_changelog_is_compacted(spark):
    out = scratch_path(spark, "changelog-test")
    step = J.changelog_batch(out, ["word"], compact_every=2)
    for b, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 1)], [("b", 2)], [("a", 3)]]):
        step(spark.createDataFrame(rows, "word string, count long"), b)
    assert sorted(map(tuple, J.compact_changelog(spark, out, ["word"]).collect())) == [("a", 3), ("b", 2), ("c", 1)]
    assert complete_folders(spark, f"{out}/base", "upto=") == [3] and complete_folders(spark, f"{out}/log", "batch_id=") == [4]


def test_cdc_apply_order_and_deletes(spark):
    row = lambda i, n: {"id": i, "first_name": n, "last_name": "L", "email": "e"}
    events = [
        _event("c", 1, row(1, "a"), 100, 10),
        _event("u", 1, row(1, "b"), 200, 20),
        _event("u", 1, row(1, "c"), 200, 20, row=1),  # same ts and pos: row decides
        _event("c", 2, row(2, "x"), 100, 11),
        _event("d", 2, None, 300, 30),
        _event("c", 3, row(3, "y"), 100, 12),
    ]
    df = spark.createDataFrame(events, "key string, value string")
    got = sorted((r.id, r.first_name) for r in cdc_apply(cdc_decode(df)).collect())
    assert got == [(1, "c"), (3, "y")]
