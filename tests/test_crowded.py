"""Codes that very many counties share: counts and joins whose pairs would not fit."""

from pyspark.sql import functions as F

from plumbmart.operators import evidence as ev
from plumbmart.operators import relational as R
from plumbmart.operators.relational import crowded_left_join, later_occurrences
from plumbmart.plans import assertions as A
from plumbmart.plans import screening
from plumbmart.plans.build import MODELS, build
from plumbmart.plans.quality import assertion_report
from plumbmart.plans.relations import schema
from plumbmart.queries import tables as T
from plumbmart.queries.catalog import QUERIES
from plumbmart.queries.inputs import spark_input
from plumbmart.session import materialise


def _rows(spark, relation, n, **cells):
    """``n`` rows of a relation, NULL but for the cells given."""
    kinds = {f.name: f.dataType for f in schema(relation).fields}
    return spark.range(n).select(*(F.expr(cells.get(c, "null")).cast(t).alias(c) for c, t in kinds.items()))


def test_screening_counts_pairs_of_a_shared_code_without_making_them(spark):
    n, sha = 3000, "repeat('a', 64)"
    mart = _rows(
        spark, A.MART, n, county_fips="'ABCDE'", cms_year="2020", svi_vintage="2022", rpl_themes="id % 10 / 10",
        rpl_themes_status="'reported'", geography_status="'current_in_scope'", reconciliation_status="'matched'",
        cms_reconciliation_row_count="1", svi_reconciliation_row_count="1", input_set_sha256=sha,
        svi_source_snapshot_sha256=sha, cms_source_content_sha256="if(id < 5, 'x', null)", svi_source_manifest_run_id="'run'",
    ).repartition(8)
    svi = _rows(
        spark, A.F_SVI, n, county_fips="'ABCDE'", svi_vintage="2022", rpl_themes="id % 10 / 10", source_manifest_run_id="'run'",
        rpl_themes_status="if(id < 10, 'unknown', 'reported')", source_snapshot_sha256=sha,
    )
    # joined, these make 3,000 * 3,000 * 4,000 rows
    county = _rows(spark, A.F_COUNTY, 4000, county_fips="'ABCDE'", year="2020", benes_om_cnt="if(id < 1000, 7, null)")
    dim = _rows(spark, "dim_county", n, county_fips="'ABCDE'", is_current_county="id > 0")
    rules = {k: A.ASSERTIONS[k] for k in ("screening_reconciles_facts_and_lineage", "screening_rows_current_and_reconciled")}
    tables = {A.MART: mart, A.F_COUNTY: county, A.F_SVI: svi, "dim_county": dim}
    found = {r.assertion: r.violations for r in assertion_report(rules, tables).collect()}
    # a row agrees with 3,000 of 4,000 county rows and 299 of 3,000 index rows; five rows have a broken hash
    assert found == {
        "screening_rows_current_and_reconciled": n,
        "screening_reconciles_facts_and_lineage": 5 * 4000 * 3000 + (n - 5) * (4000 * 3000 - 3000 * 299),
    }


def _largest_share(df):
    cells = F.xxhash64(*(f"`{c}`" for c in df.columns))
    sizes = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(cells)).collect()]
    return max(sizes) / sum(sizes)


def test_crowded_join_is_the_left_join_and_spreads_its_pairs(spark):
    key = "case when id < 2000 then 'hot' when id < 2010 then null when id < 2400 then 'left' else cast(id as string) end"
    left = spark.range(4000).selectExpr(f"{key} as k", "id as a", "id % 3 as g")
    right = spark.range(1200).selectExpr(
        "case when id < 700 then 'hot' when id < 705 then null when id < 1000 then 'right' else cast(id + 2000 as string) end as k", "id % 600 as b")
    got, plain = crowded_left_join(left, right, "k").select("k", "a", "g", "b"), left.join(right, "k", "left").select("k", "a", "g", "b")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    # the same if the left side is sized by another relation, whatever that holds
    for like in (left.where("a < 1000"), right):
        sized = crowded_left_join(left, right, "k", like=like).select("k", "a", "g", "b")
        assert sized.exceptAll(plain).count() == 0 and plain.exceptAll(sized).count() == 0
    # partitions below 1 MB are merged, so the rows are made long enough
    wide = left.selectExpr("*", "concat_ws('', transform(sequence(1, 16), i -> sha2(cast(a * 16 + i as string), 512))) as w")
    assert _largest_share(crowded_left_join(wide, right, "k")) < 0.7
    assert crowded_left_join(left.limit(0), right, "k").count() == 0
    assert crowded_left_join(left, right.limit(0), "k").count() == 4000


def test_wide_inputs_of_one_small_file_are_computed_by_many_tasks(spark, folder):
    path = f"{folder}/one-file"
    for name, rows in {
        "part": "select id as p_partkey, uuid() as p_name, uuid() as p_brand, uuid() as p_type, 1 as p_size, 1.5D as p_retailprice from range(120000)",
        "customer": "select id as c_custkey, uuid() as c_name, id % 25 as c_nationkey, 1.5D as c_acctbal, uuid() as c_phone from range(200000)",
        "nation": "select id as n_nationkey, uuid() as n_name from range(25)",
    }.items():
        spark.sql(rows).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    for name in ("raw_facility", "raw_vulnerability"):
        assert _largest_share(spark_input(spark, path, name)) < 0.6


def test_only_the_relations_asked_for_are_built(spark, monkeypatch):
    built = []

    def store(df, label, *args, **kwargs):
        built.append(label)
        return df

    monkeypatch.setattr(T, "_BUILT", {})
    monkeypatch.setattr(T, "materialise", store)
    monkeypatch.setitem(build.__kwdefaults__, "store", store)
    sf = "/root/testdata/sf0.001"
    QUERIES["build_decisions"](spark, sf)
    QUERIES["selected_models"](spark, sf)
    assert not set(built) & set(MODELS)
    QUERIES["assertions_medicare"](spark, sf)
    assert {n for n in built if n in MODELS} == {A.COUNTY, A.BENCH, A.SVI, "dim_county"}
    whole = T.mart(spark, sf)
    assert set(MODELS) <= set(whole) and sorted(built) == sorted(set(built))


def _screened(spark, n):
    """What the screening mart reads: ``n`` counties and as many index rows of one code, and some of their own."""
    sha, own = "repeat('a', 64)", f"if(id < {n}, 'ABCDE', cast(id as string))"
    return [
        _rows(spark, A.THRESHOLD, 1, cms_year="2020", svi_vintage="2022", dialysis_use_p75_threshold="0.4", screening_run_id="'run'"),
        _rows(
            spark, "dim_county", n + 40, county_fips=own, state_fips="cast(id % 3 as string)", county_name="cast(id div 2 as string)",
            is_current_county=f"id < {n} or id % 8 > 0",
        ),
        _rows(
            spark, A.F_COUNTY, 30, county_fips=f"cast(id + {n} as string)", year="2020", benes_op_dlys_pct="id % 10 / 10",
            benes_op_dlys_pct_status="if(id % 7 = 0, 'suppressed', 'reported')", source_content_sha256=sha,
        ).union(_rows(spark, A.F_COUNTY, 2, county_fips="'ABCDE'", year="2020", benes_op_dlys_pct="id / 2", benes_op_dlys_pct_status="'reported'")),
        _rows(
            spark, A.F_SVI, n + 20, county_fips=own, svi_vintage="2022", rpl_themes="if(id % 11 = 0, null, id % 10 / 10)",
            rpl_themes_status="if(id % 11 = 0, 'unavailable_null', 'reported')", source_snapshot_sha256=sha,
        ),
        _rows(spark, "audit_cms_svi_county_reconciliation", n + 50, county_fips=f"cast(id + {n} as string)", reconciliation_status="'matched'"),
    ]


def test_counted_screening_stands_for_the_rows_of_the_mart(spark, monkeypatch):
    monkeypatch.setattr(R, "CROWD_BLOCK", 4)
    monkeypatch.setattr(R, "TASK_BLOCKS", 1)
    inputs = _screened(spark, 60)
    whole = screening.mart_county_screening(*inputs)
    some = ["state_fips", "rpl_themes", "screening_quadrant"]
    for names in (some, whole.columns):
        counted = screening.counted_county_screening(*inputs, names, "times")
        plain = whole.groupBy(*names).agg(F.count(F.lit(1)).alias("times"))
        got = counted.groupBy(*names).agg(F.sum("times").alias("times"))
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert counted.count() == counted.select(*names).distinct().count()


def test_mart_checksum_is_that_of_the_rows_that_are_not_made(spark, monkeypatch):
    monkeypatch.setattr(R, "CROWD_BLOCK", 4)
    monkeypatch.setattr(R, "TASK_BLOCKS", 1)
    inputs = _screened(spark, 60)
    tables = dict(zip(MODELS[A.MART].inputs, inputs))
    # the mart itself is not there to be read
    monkeypatch.setattr(T, "mart", lambda spark, sf, names: {n: tables[n] for n in names})
    whole = screening.mart_county_screening(*inputs)
    assert [(f.name, f.dataType) for f in whole.schema.fields] == [(f.name, f.dataType) for f in schema(A.MART).fields]
    assert QUERIES["mart_checksum"](spark, "nowhere").collect() == ev.table_checksum(whole).collect()
    # 60 counties of one code and 11 scores are dealt out in blocks of 4
    assert screening.county_screening_digests(*inputs)[1] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = [inputs[0], *(df.limit(0) for df in inputs[1:])]
    digests, tasks = screening.county_screening_digests(*empty)
    kinds = {f.name: f.dataType.simpleString() for f in schema(A.MART).fields}
    assert ev.counted_checksum(digests, kinds, tasks).collect() == ev.table_checksum(screening.mart_county_screening(*empty)).collect()


def test_damage_is_counted_over_rows_that_are_not_made(spark, monkeypatch):
    inputs = _screened(spark, 20000)
    tables = dict(zip(MODELS[A.MART].inputs, inputs))
    monkeypatch.setattr(T, "mart", lambda spark, sf, names: {n: tables[n] for n in names})
    found = QUERIES["assertions_after_damage"](spark, "nowhere")
    # each of 20,000 counties has two metrics, 0.0 and 0.5, and meets 20,000 scores
    scores = [None if i % 11 == 0 else i % 10 / 10 for i in range(20000)]
    low = 20000 * sum(s is not None and s < 0.75 for s in scores)
    low += sum(
        i % 8 > 0 and i % 11 > 0 and i % 10 < 7.5 and (i - 20000) % 7 > 0 and (i - 20000) % 10 < 4 for i in range(20000, 20020)
    )
    assert {r.damage: r.violations for r in found.collect()} == {"classification": low, "threshold": 3}


def test_damage_is_counted_without_the_mart(spark, monkeypatch):
    built = []

    def store(df, label, *args, **kwargs):
        built.append(label)
        return materialise(df, label, *args, **kwargs)

    monkeypatch.setattr(T, "_BUILT", {})
    monkeypatch.setitem(build.__kwdefaults__, "store", store)
    QUERIES["assertions_after_damage"](spark, "/root/testdata/sf0.001")
    assert "int_county_screening_threshold" in built and "mart_county_screening" not in built


def test_later_occurrences_shuffle_rows_once_and_keys_once(spark):
    rows = spark.range(5000).selectExpr("if(id < 3000, 1, id div 2) as k", "id div 3 as at", "id % 7 as x")
    later = later_occurrences(rows, ["k"], "at")
    assert later.count() == 2999 + 1000 and later.agg(F.max("key_row_count")).first()[0] == 3000
    assert "Window" not in later._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_long_keys_are_counted_by_their_digest(spark):
    rows = spark.range(400).selectExpr("if(id % 100 = 0, null, repeat(cast(id % 200 as string), 500)) as text", "if(id % 2 = 0, null, 'a') as b")
    header = ["text", "b"]
    found = ev.file_shape(rows, header, header, header, F.lit(400))
    # the values but one that 100 leaves come twice; NULL has four rows
    assert (found.first().row_count, found.first().repeated_key_count) == (400, 199)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [text" not in plan
