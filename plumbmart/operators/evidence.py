"""Snapshot evidence: fingerprints, canonical hashes, page and load reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.operators.ordering import ordered, with_next
from plumbmart.operators.relational import one_row

# Records of a rolled-up list that are hashed together.
ROLL = 4096
# Pages planned per generated block.
PLAN_BLOCK = 4096


def canonical_json(value: Column) -> Column:
    """Compact JSON with NULLs kept; give struct fields in sorted order."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def ordered_list(df: DataFrame, order: str, record: Column) -> DataFrame:
    """One row holding ``records`` in ``order``.

    For lists that a contract bounds (the columns of a schema, the sources of a
    build), as the canonical form is one value. Relations have ``rolled_sha256``
    and ``table_checksum``.
    """
    entry = F.struct(F.col(order).alias("place"), record.alias("record"))
    collected = df.select(entry.alias("entry")).agg(F.collect_list("entry").alias("entries"))
    return collected.select(
        F.transform(F.array_sort("entries"), lambda e: e["record"]).alias("records")
    )


def rolled_sha256(df: DataFrame, place: str, record: Column, alias: str = "sha256") -> DataFrame:
    """SHA-256 of a list of any length, ordered by a whole number of its own for every record.

    The records of every ``ROLL`` places are hashed as one JSON array, then those
    digests with the number of their block likewise, four times in all: no task
    holds more than ``ROLL`` records, for lists of up to ROLL**4 places.
    """
    level = df.select(F.col(place).cast("bigint").alias("at"), canonical_json(record).alias("digest"))
    for step in range(4):
        block = F.floor(F.col("at") / ROLL) if step < 3 else F.lit(0).cast("bigint")
        entry = F.struct("at", "digest")
        level = level.groupBy(block.alias("block")).agg(
            F.sha2(canonical_json(F.array_sort(F.collect_list(entry))), 256).alias("digest")
        ).withColumnRenamed("block", "at")
    return level.select(F.col("digest").alias(alias))


def list_sha256(df: DataFrame, order: str, record: Column, alias: str = "sha256") -> DataFrame:
    """SHA-256 of the canonical JSON array of ``record`` in ``order``."""
    listed = ordered_list(df, order, record)
    return listed.select(F.sha2(canonical_json(F.col("records")), 256).alias(alias))


def schema_sha256(columns: DataFrame, order: str = "position") -> DataFrame:
    """Hash of ordered (declared_type, name) pairs."""
    return list_sha256(columns, order, F.struct("declared_type", "name"), "schema_sha256")


def header_sha256(columns: DataFrame, order: str = "position") -> DataFrame:
    """Hash of the ordered column labels."""
    return list_sha256(columns, order, F.col("name"), "header_sha256")


def snapshot_sha256(pages: DataFrame) -> DataFrame:
    """Identity of the ordered page set of one published snapshot, as its manifest lists it."""
    identity = F.struct(
        "byte_count", "content_sha256", "page_index", "record_count", "result_offset"
    )
    return list_sha256(pages, "page_index", identity, "snapshot_sha256")


def input_set_sha256(audits: DataFrame, format_version: int) -> DataFrame:
    """Identity of a set of loaded sources, whatever order they were loaded in."""
    record = F.struct(
        "contract_version", "manifest_run_id", "page_count", "row_count",
        "snapshot_sha256", "source_id",
    )
    payload = F.struct(
        F.lit(format_version).alias("build_format_version"), F.col("records").alias("sources")
    )
    return ordered_list(audits, "source_id", record).select(
        F.sha2(F.concat(canonical_json(payload), F.lit("\n")), 256).alias("input_set_sha256")
    )


# -- pages -------------------------------------------------------------------------


def page_evidence(rows: DataFrame, page: Sequence[str], key: str, position: str, *more: Column) -> DataFrame:
    """Record count, first and last key of each page, its records whose key does not rise, and ``more`` aggregates."""
    before = F.lag(key).over(Window.partitionBy(*page).orderBy(position))
    return rows.withColumn("_before", before).groupBy(*page).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min_by(key, position).alias("first_key"),
        F.max_by(key, position).alias("last_key"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
        F.count_if(F.col(key) <= F.col("_before")).alias("unordered_count"),
        *more,
    )


def page_report(rows: DataFrame, page: Sequence[str], offset: str, key: str, page_size: int, announced: Column) -> DataFrame:
    """One row of evidence a parsed page: what was read, what was announced for its offset, and whether it is complete.

    ``rows`` are parsed records; ``page`` names what tells pages apart, such as
    offset, bytes and digest, and is kept. ``problem_count`` counts records, or
    pages, that broke the contract; a page without records has a record count of 0.
    """
    counts = F.count("position").alias("__read"), F.count("problem").alias("problem_count")
    seen = page_evidence(rows, page, key, "position", *counts).withColumn("record_count", F.col("__read")).drop("__read")
    expected = F.greatest(F.least(F.lit(page_size).cast("bigint"), announced - F.col(offset)), F.lit(0))
    seen = seen.withColumn("expected_count", F.coalesce(expected, F.lit(0)))
    clean = (F.col("problem_count") == 0) & (F.col("unordered_count") == 0)
    return seen.withColumn("complete", clean & (F.col("record_count") == F.col("expected_count")))


def page_order_violations(
    rows: DataFrame, page: str, offset: str, key: str, position: str
) -> DataFrame:
    """Neighbouring records of an ordered page set whose keys do not increase.

    Neighbours are the records that follow each other, whatever the gap in their
    places. Within a page that is a window on the page; across pages the last
    record of one is compared with the first of the next that has records, from
    one row a page.
    """
    placed = rows.select(
        F.col(page).alias("page"),
        F.col(offset).cast("bigint").alias("offset"),
        F.col(position).cast("bigint").alias("position"),
        F.col(key).alias("key"),
    )
    inside = Window.partitionBy("page", "offset").orderBy("position")
    near = placed.withColumns({"next_page": F.col("page"), "next_key": F.lead("key").over(inside)})
    record = F.struct("position", "key")
    ends = placed.groupBy("page", "offset").agg(F.min(record).alias("head"), F.max(record).alias("tail"))
    following = F.struct("page", F.col("head.key").alias("key"))
    pages = with_next(ordered(ends, [F.col("offset"), F.col("page")], "pages"), following, "after")
    across = pages.select(
        "page", "offset", F.col("tail.position").alias("position"), F.col("tail.key").alias("key"),
        F.col("after.page").alias("next_page"), F.col("after.key").alias("next_key"),
    )
    both = near.select(*across.columns).union(across).where(F.col("next_key") <= F.col("key"))
    return both.select("page", (F.col("offset") + F.col("position")).alias("place"), "key", "next_page", "next_key")


def page_plan_issues(pages: DataFrame, record_count: Column, page_size: int) -> DataFrame:
    """Pages that are missing, surplus, misplaced or of the wrong size.

    ``pages`` has ``page_index``, ``result_offset`` and ``record_count``; the
    plan is every multiple of ``page_size`` below ``record_count``.
    """
    total = pages.sparkSession.range(1).select(record_count.cast("bigint").alias("total"))
    # two short sequences instead of one array as long as the page set
    last_block = F.floor(F.greatest(F.col("total") - 1, F.lit(0)) / (page_size * PLAN_BLOCK))
    blocks = total.select("total", F.explode(F.sequence(F.lit(0), last_block)).alias("block"))
    planned = (
        blocks.repartition("block")
        .select("total", "block", F.explode(F.sequence(F.lit(0), F.lit(PLAN_BLOCK - 1))).alias("i"))
        .select("total", (F.col("block") * PLAN_BLOCK + F.col("i")).alias("planned_index"))
        .withColumn("result_offset", F.col("planned_index") * page_size)
        .where(F.col("result_offset") < F.col("total"))
        .select(
            "result_offset", "planned_index",
            F.least(F.lit(page_size), F.col("total") - F.col("result_offset")).alias("planned_count"),
        )
    )
    both = planned.join(pages.select("page_index", "result_offset", "record_count"),
                        "result_offset", "full")
    code = (
        F.when(F.col("page_index").isNull(), "missing_page")
        .when(F.col("planned_index").isNull(), "unplanned_page")
        .when(F.col("page_index") != F.col("planned_index"), "page_index_not_contiguous")
        .when(F.col("record_count") != F.col("planned_count"), "page_row_count_mismatch")
    )
    return both.select(
        code.alias("code"), "result_offset", "planned_count", "record_count"
    ).where(F.col("code").isNotNull())


def page_set_summary(
    rows: DataFrame, object_id: str, county: str, district: str, territories: Sequence[str]
) -> DataFrame:
    """Totals that make an ordered page set a complete county snapshot."""
    return rows.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.countDistinct(object_id).alias("distinct_object_ids"),
        F.countDistinct(county).alias("distinct_county_fips"),
        F.coalesce(F.bool_or(F.col(county) == district), F.lit(False)).alias("district_present"),
        F.count_if(F.substring(county, 1, 2).isin(*territories)).alias("territory_row_count"),
    )


def page_set_issues(summary: DataFrame, announced: Column) -> DataFrame:
    """The rules that a page set's summary breaks, with the counts found and wanted."""
    found, n = F.col, F.col("record_count")
    rules = (
        ("record_count_mismatch", n, announced),
        ("object_ids_not_distinct", found("distinct_object_ids"), n),
        ("counties_not_distinct", found("distinct_county_fips"), n),
        ("district_missing", found("district_present").cast("bigint"), F.lit(1)),
        ("territory_present", found("territory_row_count"), F.lit(0)),
    )
    checked = [
        F.when(
            seen != want,
            F.struct(F.lit(code).alias("code"), seen.cast("bigint").alias("found"), want.cast("bigint").alias("wanted")),
        )
        for code, seen, want in rules
    ]
    return summary.select(F.explode(F.array_compact(F.array(*checked))).alias("issue")).select("issue.*")


# -- recorded against recomputed ------------------------------------------------------


def evidence_differences(
    recorded: DataFrame, recomputed: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """One row per evidence field that differs between record and recomputation."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            *keys, F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias(tag)
        )

    joined = side(recorded, "recorded").join(side(recomputed, "recomputed"), list(keys), "full")
    hits = [
        F.when(
            ~F.col(f"recorded.{f}").eqNullSafe(F.col(f"recomputed.{f}")),
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"recorded.{f}").alias("recorded"),
                F.col(f"recomputed.{f}").alias("recomputed"),
            ),
        )
        for f in fields
    ]
    return joined.select(
        *keys, F.explode(F.array_compact(F.array(*hits))).alias("d")
    ).select(*keys, "d.*")


def load_decision(
    table: DataFrame, audit: DataFrame, expected: DataFrame, lineage: Sequence[str]
) -> DataFrame:
    """``loaded``, ``database_noop`` or ``conflict`` for one source.

    ``expected`` is one row with the lineage and ``row_count`` of the verified
    snapshot. An absent table means load; equal lineage, audit and count mean
    nothing to do; anything else is a conflict.
    """
    want = one_row(expected, *lineage, "row_count")
    same = F.lit(True)
    for name in lineage:
        same = same & F.col(name).eqNullSafe(want[name])
    matching = table.agg(
        F.count(F.lit(1)).alias("stored_rows"), F.count_if(~same).alias("foreign_rows")
    )
    audits = audit.agg(
        F.count(F.lit(1)).alias("audits"),
        F.count_if(same & F.col("row_count").eqNullSafe(want["row_count"])).alias("good"),
    )
    state = matching.withColumns({"a": one_row(audits), "want": want})
    absent = (F.col("stored_rows") == 0) & (F.col("a.audits") == 0)
    equal = (
        (F.col("a.audits") == 1) & (F.col("a.good") == 1) & (F.col("foreign_rows") == 0)
        & (F.col("stored_rows") == F.col("want.row_count"))
    )
    return state.select(
        F.when(absent, "loaded").when(equal, "database_noop").otherwise("conflict").alias("decision"),
        "stored_rows", "foreign_rows", F.col("want.row_count").alias("expected_rows"),
    )


def content_decision(incoming: DataFrame, stored: DataFrame, fingerprint: str) -> DataFrame:
    """Mark incoming content already held (same bytes) as a no-op."""
    held = stored.select(F.col(fingerprint)).distinct().withColumn("content_noop", F.lit(True))
    return incoming.join(held, fingerprint, "left").withColumn(
        "content_noop", F.coalesce("content_noop", F.lit(False))
    )


def lineage_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows per lineage tuple."""
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count"))


def file_evidence(files: DataFrame) -> DataFrame:
    """Path, byte count and SHA-256 of each file of a ``binaryFile`` scan."""
    return files.select(
        "path", F.col("length").alias("byte_count"), F.sha2("content", 256).alias("content_sha256")
    )


def csv_evidence(rows: DataFrame, key: str) -> DataFrame:
    """Row, distinct-key and leading-zero counts of a keyed all-text file."""
    k = F.col(f"`{key}`")
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(k).alias("distinct_key_count"),
        F.count_if(k.startswith("0")).alias("leading_zero_count"),
    )


def file_shape(
    rows: DataFrame, header: Sequence[str], published: Sequence[str], keys: Sequence[str], announced: Column
) -> DataFrame:
    """One row of evidence on a scanned file against what was published about it.

    ``header`` is the file's own list of labels, ``rows`` has at least ``keys``. Keys may be
    long texts, so their digests are counted.
    """
    listed = sorted({h for h in header if h not in published})
    repeated = rows.select(row_digest(rows, keys).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    counted = repeated.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("n") > 1).alias("repeated_key_count"),
    )
    labels = F.to_json(F.array(*(F.lit(h) for h in header)))
    return counted.select(
        F.lit(list(header) == list(published)).alias("header_as_published"),
        F.lit(len(set(header)) != len(header)).alias("header_repeats"),
        F.sha2(labels, 256).alias("header_sha256"),
        F.lit(len(listed)).alias("additive_columns"),
        "row_count",
        (F.col("row_count") == announced).alias("row_count_as_announced"),
        "repeated_key_count",
    )


# -- checksum of a whole relation --------------------------------------------------------


def cell_text(value: Column) -> Column:
    """A cell as text behind its length, a NULL as ``~``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def row_text(columns: Sequence[str]) -> Column:
    return F.concat(*(cell_text(F.col(f"`{c}`")) for c in columns))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a row as text: each cell behind its length, a NULL as ``~``."""
    return F.sha2(row_text(columns), 256)


def table_checksum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One digest of a relation and its column names and types, independent of row order and partitioning.

    Equal rows are counted first, so copies cost nothing; digests then roll up
    by hash prefix (six digits, three, none), so no task holds more than its
    share of the distinct rows, and at most 4,096 digests above that.
    """
    names = sorted(columns or df.columns)
    counted = df.select(row_digest(df, names).alias("h")).groupBy("h").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted_checksum(counted, {c: kind for c, kind in df.dtypes if c in names})


def counted_checksum(counted: DataFrame, kinds: Mapping[str, str], tasks: int | None = None) -> DataFrame:
    """``table_checksum`` of a relation with columns of these types, whose different rows come as digests ``h`` with their number ``n``.

    ``tasks`` fixes the number of tasks that bring the digests together.
    """
    heading = ",".join(f"{c}:{kinds[c]}" for c in sorted(kinds))
    level = counted.select(
        F.substring("h", 1, 6).alias("prefix"),
        F.concat_ws(":", "h", F.col("n").cast("string")).alias("digest"), "n",
    )
    if tasks:
        level = level.repartition(tasks, "prefix")
    for width in (3, 0, 0):
        level = level.groupBy("prefix").agg(
            F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list("digest"))), 256).alias("digest"),
            F.sum("n").alias("n"),
        ).withColumn("prefix", F.substring("prefix", 1, width))
    total = level.agg(F.max("digest").alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(
        F.sha2(F.concat_ws("\n", F.lit(heading), F.coalesce("digest", F.lit(""))), 256).alias("checksum"),
        F.col("n").alias("row_count"),
    )
