import json
import os

import pytest
from pyspark.sql import functions as F

from plumbmart.sources import contracts as C
from plumbmart.sources import sinks
from plumbmart.sources.files import (
    HeaderError, columns_frame, csv_header, header_issues, scan_csv, scan_fingerprints,
)
from plumbmart.sources.pages import page_problems, scan_pages
from plumbmart.sources.seeds import historical_county_identities
from samples import county, sha, write_csv, write_pages


def text(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(body)
    return path


def test_scan_keeps_text_as_received(spark, folder):
    path = write_csv(f"{folder}/a/x.csv", ["A", "B", "C"], [
        ["01", " NA ", "x"], ["", "two\nlines", "with, comma"], ["007", 'quo"te', ""]])
    got = scan_csv(spark, path, ["C", "A", "B"]).collect()
    assert [tuple(r) for r in got] == [
        ("x", "01", " NA "), ("with, comma", "", "two\nlines"), ("", "007", 'quo"te')]


@pytest.mark.parametrize("body", ["A,B\n1\n", "A,B\n1,2,3\n"])
def test_ragged_rows_stop_the_scan_even_when_pruned(spark, folder, body):
    path = text(f"{folder}/ragged{len(body)}/x.csv", body)
    with pytest.raises(Exception, match="(?i)malformed|CSV"):
        scan_csv(spark, path, ["A"]).collect()


def test_header_problems(spark, folder):
    assert csv_header(spark, text(f"{folder}/h1/x.csv", '"A, x",B\n1,2\n')) == ["A, x", "B"]
    with pytest.raises(HeaderError, match="repeated"):
        scan_csv(spark, text(f"{folder}/h2/x.csv", "A,A\n1,2\n"), ["A"])
    with pytest.raises(HeaderError, match="missing"):
        scan_csv(spark, text(f"{folder}/h3/x.csv", "A,B\n1,2\n"), ["Z"])
    with pytest.raises(HeaderError, match="empty"):
        scan_csv(spark, text(f"{folder}/h4/x.csv", ""), ["Z"])


def test_files_of_one_folder_must_share_the_header(spark, folder):
    write_csv(f"{folder}/many/1.csv", ["A", "B"], [["1", "2"]])
    write_csv(f"{folder}/many/2.csv", ["B", "A"], [["1", "2"]])
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, f"{folder}/many", ["A"]).collect()


def test_header_issues(spark):
    seen, want = columns_frame(spark, ["A", "C", "C"]), columns_frame(spark, ["A", "B"])
    got = {tuple(r) for r in header_issues(seen, want).collect()}
    assert got == {("duplicate_header", "C"), ("header_mismatch", "B"), ("header_mismatch", "C")}


def test_page_tokens_are_source_text(spark, folder):
    names = ["A", "B"]
    path = f"{folder}/pages1"
    text(f"{path}/page-000000.json",
         '{"features":[{"attributes":{"A":0.7500,"B":null}},{"attributes":{"A":1e-3,"B":"x"}}],'
         '"exceededTransferLimit":true}')
    text(f"{path}/page-000002.json",
         '{"features":[{"attributes":{"A":0.1234567890123456789,"B":100000000000000000000.10}}]}')
    got = scan_pages(spark, path, names).orderBy("page_offset", "position").collect()
    assert [(r.page_offset, r.position, r.A, r.B, r.more_pages) for r in got] == [
        (0, 0, "0.7500", None, True), (0, 1, "1e-3", "x", True),
        (2, 0, "0.1234567890123456789", "100000000000000000000.10", None)]
    with open(f"{path}/page-000002.json") as f:
        assert got[2].page_sha256 == sha(f.read())


@pytest.mark.parametrize("body,problem", [
    ("{}", "not a JSON object"), ("not json", "not a JSON object"), ("[1]", "not a JSON object"),
    ('{"features":[]}', "no records"), ('{"features":[1]}', "no attributes"),
    ('{"features":[{"geometry":1,"attributes":{"A":1}}]}', "geometry"),
    ('{"features":[{"attributes":{"A":1,"Z":2}}]}', "attributes differ: Z"),
    ('{"features":[{"attributes":{"A":{"x":1}}}]}', "unexpected value"),
])
def test_bad_pages_are_reported(spark, folder, body, problem):
    path = f"{folder}/bad-{abs(hash(body))}"
    text(f"{path}/page-000000.json", body)
    got = page_problems(scan_pages(spark, path, ["A"])).collect()
    assert len(got) == 1 and problem in got[0].problem


def test_fingerprints(spark, folder):
    path = text(f"{folder}/fp/x.csv", "A\n1\n")
    row = scan_fingerprints(spark, path).collect()[0]
    assert (row.byte_count, row.content_sha256) == (4, sha("A\n1\n"))


def test_seed(spark):
    seed = historical_county_identities(spark)
    assert seed.count() == 11
    assert seed.groupBy("state_abbreviation").count().orderBy("count").collect()[-1][0] == "CT"
    assert seed.where(F.substring("county_fips", 1, 2) != F.col("state_fips")).count() == 0


def test_write_raw_checks_the_written_rows(spark, folder):
    df = spark.createDataFrame([("a",), ("b",)], "A string")
    stored = sinks.write_raw(df, f"{folder}/raw/ok", {"source_id": "s"}, {"row_count": 2, "page_count": 1})
    rows, audit = sinks.read_raw(spark, f"{folder}/raw/ok")
    assert stored.columns == ["A", "source_id"] and rows.count() == 2
    assert audit.select("row_count", "source_id", "page_count").collect()[0] == (2, "s", 1)
    with pytest.raises(sinks.LoadMismatch):
        sinks.write_raw(df, f"{folder}/raw/bad", {"source_id": "s"}, {"row_count": 3})
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_raw(df, f"{folder}/raw/ok", {"source_id": "s"}, {"row_count": 2})


def test_build_audit_formats(spark):
    def audit(source):
        return spark.createDataFrame(
            [(source, "run", "v", sha(source), "t", 1, 3)],
            "source_id string, manifest_run_id string, contract_version string,"
            " snapshot_sha256 string, retrieved_at_utc string, page_count bigint, row_count bigint")

    cms, svi, fac = audit("m"), audit("v"), audit("f")
    two = sinks.build_input_audit("b", {"cms": cms, "svi": svi}).collect()[0]
    three = sinks.build_input_audit("b", {"cms": cms, "svi": svi, "facility": fac}).collect()[0]
    assert (two.build_format_version, two.facility_row_count) == (1, None)
    record = lambda s: {"contract_version": "v", "manifest_run_id": "run", "page_count": 1,
                        "row_count": 3, "snapshot_sha256": sha(s), "source_id": s}
    payload = {"build_format_version": 2, "sources": [record(s) for s in "fmv"]}
    want = json.dumps(payload, separators=(",", ":"), sort_keys=True) + "\n"
    assert three.input_set_sha256 == sha(want)
    counts = sinks.combined_counts({"cms": cms, "svi": svi}, sinks.build_input_audit(
        "b", {"cms": cms, "svi": svi})).collect()
    assert {(r.source, r.stored_rows, r.audited_rows) for r in counts} == {("cms", 1, 3), ("svi", 1, 3)}
