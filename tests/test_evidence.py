import json

import pytest
from pyspark.sql import functions as F

from plumbmart.operators import evidence as ev
from plumbmart.sources.files import columns_frame
from plumbmart.sources.pages import parse_pages
from plumbmart.sources.sinks import build_decision, build_input_audit
from samples import sha


def compact(value):
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def test_list_hashes_equal_canonical_json(spark):
    columns = columns_frame(spark, ["b", "a/ü", 'q"x'], ["TEXT", "NUM", "TEXT"])
    want = [{"name": n, "declared_type": t} for n, t in (("b", "TEXT"), ("a/ü", "NUM"), ('q"x', "TEXT"))]
    assert ev.schema_sha256(columns).collect()[0][0] == sha(compact(want))
    assert ev.header_sha256(columns.repartition(3)).collect()[0][0] == sha(compact(["b", "a/ü", 'q"x']))
    pages = spark.createDataFrame([(1, 2, 1, 9, "y"), (0, 0, 2, 7, "x")],
                                  "page_index int, result_offset int, record_count int, byte_count int, content_sha256 string")
    want = [{"page_index": 0, "result_offset": 0, "record_count": 2, "byte_count": 7, "content_sha256": "x"},
            {"page_index": 1, "result_offset": 2, "record_count": 1, "byte_count": 9, "content_sha256": "y"}]
    assert ev.snapshot_sha256(pages).collect()[0][0] == sha(compact(want))


def test_rolled_hash_depends_on_place_and_content(spark, monkeypatch):
    monkeypatch.setattr(ev, "ROLL", 3)
    def digest(rows):
        df = spark.createDataFrame(rows, "at bigint, v string").repartition(3)
        return ev.rolled_sha256(df, "at", F.struct("v")).collect()[0][0]

    rows = [(i, f"v{i}") for i in range(40)]
    level = [(i, compact({"v": v})) for i, v in rows]
    for step in range(4):
        blocks = {}
        for at, d in level:
            blocks.setdefault(at // 3 if step < 3 else 0, []).append({"at": at, "digest": d})
        level = [(b, sha(compact(entries))) for b, entries in sorted(blocks.items())]
    assert digest(rows) == digest(rows[::-1]) == level[0][1]
    assert digest(rows[:-1]) != digest(rows) != digest([(41 if i == 39 else i, v) for i, v in rows])


def brute_checksum(rows, heading="k:string,v:string"):
    digests = [sha("".join("~" if v is None else f"{len(v)}:{v}" for v in r)) for r in rows]
    counts = {h: digests.count(h) for h in set(digests)}
    level = [(h[:6], f"{h}:{n}") for h, n in counts.items()]
    for width in (6, 3, 0):
        groups = {}
        for prefix, digest in level:
            groups.setdefault(prefix[:width], []).append(digest)
        level = [(p, sha("\n".join(sorted(d)))) for p, d in groups.items()]
    return sha(heading + "\n" + level[0][1])


def test_checksum_tells_cells_names_and_types_apart(spark):
    checksum = lambda rows, kind: ev.table_checksum(spark.createDataFrame(rows, kind)).collect()[0].checksum
    base = checksum([("a\x1f=b", "c")], "k string, v string")
    assert base != checksum([("a", "b\x1f=c")], "k string, v string")
    assert base != checksum([("a\x1f=b", "c")], "k string, w string")
    assert checksum([(1,)], "k int") != checksum([(1,)], "k bigint")
    assert checksum([("~",)], "k string") != checksum([(None,)], "k string")
    assert ev.table_checksum(spark.createDataFrame([], "k string")).collect()[0].row_count == 0


def test_checksum_ignores_order_and_partitions_but_not_content(spark):
    data = [("a", None), ("a", ""), ("b", "x"), ("b", "x")] + [(f"k{i}", str(i)) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v string")
    one = ev.table_checksum(df).collect()[0]
    assert (one.checksum, one.row_count) == (brute_checksum(data), 304)
    assert ev.table_checksum(df.orderBy(F.desc("k")).repartition(7)).collect()[0].checksum == one.checksum
    assert ev.table_checksum(df.withColumn("v", F.coalesce("v", F.lit("")))).collect()[0].checksum != one.checksum
    assert ev.table_checksum(df.dropDuplicates()).collect()[0].checksum != one.checksum


def test_page_order_and_evidence(spark):
    rows = [(0, 0, 0, 1), (0, 0, 1, 2), (1, 2, 0, 2), (1, 2, 1, 5)]
    df = spark.createDataFrame(rows, "page int, offset int, pos int, id int")
    bad = ev.page_order_violations(df, "page", "offset", "id", "pos").collect()
    assert [(r.page, r.place, r.key, r.next_key) for r in bad] == [(0, 1, 2, 2)]
    gaps = spark.createDataFrame([(0, 0, 0, 10), (0, 0, 1, 11), (1, 4, 0, 5), (1, 4, 1, 6), (3, 90, 2, 6)], "page int, offset int, pos int, id int")
    bad = ev.page_order_violations(gaps, "page", "offset", "id", "pos").collect()
    assert sorted((r.page, r.place, r.key, r.next_page, r.next_key) for r in bad) == [(0, 1, 11, 1, 5), (1, 5, 6, 3, 6)]
    got = ev.page_evidence(df, ["page"], "id", "pos").orderBy("page").collect()
    assert [(r.record_count, r.first_key, r.last_key) for r in got] == [(2, 1, 2), (2, 2, 5)]


def test_page_plan(spark):
    kind = "page_index bigint, result_offset bigint, record_count bigint"
    def issues(pages, total):
        df = spark.createDataFrame(pages, kind)
        return sorted((r.code, r.result_offset) for r in ev.page_plan_issues(df, F.lit(total), 2).collect())

    assert issues([(0, 0, 2), (1, 2, 1)], 3) == []
    assert issues([(0, 0, 1), (2, 2, 1), (3, 6, 1)], 5) == [
        ("missing_page", 4), ("page_index_not_contiguous", 2), ("page_row_count_mismatch", 0),
        ("unplanned_page", 6)]
    assert issues([(0, 0, 2)], 0) == [("unplanned_page", 0)]


def test_page_set_summary(spark):
    df = spark.createDataFrame([("1", "01001"), ("2", "11001"), ("2", "72001")], "id string, fips string")
    summary = ev.page_set_summary(df, "id", "fips", "11001", ["72"])
    assert tuple(summary.collect()[0]) == (3, 2, 3, True, 1)
    issues = sorted(tuple(r) for r in ev.page_set_issues(summary, F.lit(4)).collect())
    assert issues == [("object_ids_not_distinct", 2, 3), ("record_count_mismatch", 3, 4), ("territory_present", 1, 0)]


def test_evidence_differences(spark):
    a = spark.createDataFrame([("x", 1, "h"), ("y", 2, None)], "k string, n int, h string")
    b = spark.createDataFrame([("x", 1, "g"), ("z", 2, None)], "k string, n int, h string")
    got = sorted((r.k, r.field, r.recorded, r.recomputed)
                 for r in ev.evidence_differences(a, b, ["k"], ["n", "h"]).collect())
    assert got == [("x", "h", "h", "g"), ("y", "n", "2", None), ("z", "n", None, "2")]


def test_load_decisions(spark):
    kind = "source_id string, sha string, row_count bigint"
    table = spark.createDataFrame([("s", "h")] * 3, "source_id string, sha string")
    audit = spark.createDataFrame([("s", "h", 3)], kind)

    def decide(t, a, e):
        return ev.load_decision(t, a, e, ["source_id", "sha"]).collect()[0].decision

    empty, none = table.where("false"), audit.where("false")
    assert decide(table, audit, audit) == "database_noop"
    assert decide(empty, none, audit) == "loaded"
    assert decide(table, audit, audit.withColumn("sha", F.lit("other"))) == "conflict"
    assert decide(table.limit(2), audit, audit) == "conflict"
    assert decide(table, audit.union(audit), audit) == "conflict"
    assert decide(table.union(spark.createDataFrame([("s", None)], table.schema)), audit, audit) == "conflict"


def test_content_decision_and_file_counts(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b")], "i int, h string")
    held = spark.createDataFrame([("a",), ("a",)], "h string")
    assert sorted(tuple(r) for r in ev.content_decision(new, held, "h").select("i", "content_noop").collect()) == [
        (1, True), (2, False)]
    df = spark.createDataFrame([("01",), ("1",), ("01",)], "`a b` string")
    assert tuple(ev.csv_evidence(df, "a b").collect()[0]) == (3, 2, 2)
    shape = ev.file_shape(df, ["a b", "x"], ["a b"], ["a b"], F.lit(3)).collect()[0]
    assert tuple(shape) == (False, False, sha('["a b","x"]'), 1, 3, True, 1)


def test_build_decision(spark):
    source = "source_id string, manifest_run_id string, contract_version string, snapshot_sha256 string, retrieved_at_utc string, page_count bigint, row_count bigint"
    one = {p: spark.createDataFrame([(p, "run", "v", "h" + p, "t", 1, n)], source) for p, n in (("cms", 3), ("svi", 2))}
    audit = build_input_audit("b", one)
    tables = {"cms": spark.range(3), "svi": spark.range(2), "facility": spark.range(0)}

    def decide(t, a, e):
        r = build_decision(t, a, e).collect()[0]
        return r.decision, r.differing

    none = audit.where("false")
    assert decide(tables, audit, audit) == ("database_noop", [])
    assert decide({p: t.limit(0) for p, t in tables.items()}, none, audit) == ("loaded", [])
    assert decide(tables, none, audit) == ("conflict", [])
    assert decide(tables, audit.union(audit), audit) == ("conflict", [])
    assert decide({**tables, "svi": spark.range(1)}, audit, audit) == ("conflict", ["svi_stored_rows"])
    assert decide({**tables, "facility": spark.range(1)}, audit, audit) == ("conflict", ["facility_stored_rows"])
    three = build_input_audit("b", {**one, "facility": spark.createDataFrame([("facility", "run", "v", "h", "t", 1, 0)], source)})
    assert decide(tables, audit, three)[0] == "conflict"
    assert decide(tables, audit, audit.withColumn("cms_page_count", F.lit(2))) == ("conflict", ["cms_page_count"])


def test_page_report(spark):
    bodies = {0: '{"features":[{"attributes":{"K":"a"}},{"attributes":{"K":"b"}}]}', 2: '{"features":[{"attributes":{"K":"d"}},{"attributes":{"K":"c"}}]}',
              4: '{"features":[{"attributes":{"K":"e"},"geometry":1}]}', 6: '{"features":[]}', 8: "no page"}
    pages = spark.createDataFrame([(k, len(b), sha(b), b) for k, b in bodies.items()], "o bigint, n bigint, h string, body string")
    rows = parse_pages(pages, "body", ["o", "n", "h"], ["K"])
    got = {r.o: (r.n, r.h, r.record_count, r.expected_count, r.first_key, r.unordered_count, r.problem_count, r.complete)
           for r in ev.page_report(rows, ["o", "n", "h"], "o", "K", 2, F.lit(7)).collect()}
    own = {k: (len(b), sha(b)) for k, b in bodies.items()}
    assert got == {0: (*own[0], 2, 2, "a", 0, 0, True), 2: (*own[2], 2, 2, "d", 1, 0, False), 4: (*own[4], 1, 2, None, 0, 1, False),
                   6: (*own[6], 0, 1, None, 0, 1, False), 8: (*own[8], 0, 0, None, 0, 1, False)}
    assert ev.page_report(rows.limit(0), ["o", "n", "h"], "o", "K", 2, F.lit(7)).count() == 0
