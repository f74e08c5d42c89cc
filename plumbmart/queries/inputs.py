"""Raw source-shaped relations derived from the benchmark tables.

Customers stand for counties, nations for states, orders and lineitems for the
measured activity, parts for facilities. Every relation covers its whole tables,
so the models and assertions run at whatever size those have. Tokens such as
``*``, blanks, ``NA``, sentinels and broken numbers are injected by key, and a
few keys are duplicated, missing or malformed, so that every status and most
assertions have something to find.

The text is plain SQL that Spark and DuckDB both run; only a few functions
differ by name. It prepares input and holds no
operator under test.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession

from plumbmart.sources import contracts as C

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _share(part: str, whole: str, digits: int = 4) -> str:
    unit = 10**digits
    scaled = f"(({part}) * {unit} $div ({whole}))"
    return f"printf('%d.%0{digits}d', {scaled} $div {unit}, {scaled} % {unit})"


def _noisy(text: str, key: str, place: int) -> str:
    """Publication gaps and damage, spread over keys, years and metrics."""
    slot = f"(slot + {3 * place}) % 29"
    return (
        f"case {slot} when 0 then '*' when 1 then '' when 2 then 'NA' when 3 then ' na '"
        f" when 4 then ' ' || ({text}) || ' '"
        f" else case when {slot} = 5 and {key} % 50 = 0 then 'BROKEN'"
        f" when {slot} = 6 and {key} % 40 = 0 then '-' || ({text})"
        f" when {slot} = 7 and {key} % 30 = 0 then ({text}) || '.5'"
        f" else ({text}) end end"
    )


_ACTIVITY = (
    "n", "urgent", "partial", "done", "ret", "qty", "cents", "low", "high",
)
_METRIC_TEXT = {
    "benes_om_cnt": "cast(n as string)",
    "ma_prtcptn_rate": _share("urgent", "n"),
    "bene_dual_pct": _share("partial", "n"),
    "benes_op_dlys_cnt": "cast(done as string)",
    "benes_op_dlys_pct": f"case when qty = 0 then '' else {_share('ret', 'greatest(qty, 1)', 6)} end",
    "op_dlys_visits_per_1000_benes": "cast(done * 1000 $div n as string)",
    "op_dlys_mdcr_stdzd_pymt_pc": "printf('%d.%02d', cents $div n $div 100, cents $div n % 100)",
    "acute_hosp_readmsn_pct": _share("low", "n"),
    "er_visits_per_1000_benes": "cast(high * 1000 $div n as string)",
}


def _lineage(source: str, label: str, hash_name: str, release: bool = False) -> str:
    out = (
        f"'{source}' as source_id, 'derived-{label}-run' as source_manifest_run_id,"
        f" $sha('{label}'$bits) as {hash_name},"
        f" '2026-08-15T01:50:00Z' as source_retrieved_at_utc,"
    )
    if release:
        out += " '2026-07' as source_release,"
    return out + " '2026-05-15' as source_modified_at"


_TOTALS = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in _ACTIVITY)
_STATE_CODE = "case n_nationkey when 4 then '11' else lpad(cast(n_nationkey * 3 as string), 2, '0') end"
_STATE_LABEL = "case n_nationkey when 4 then 'DC' else chr(65 + n_nationkey) || chr(65 + n_nationkey) end"


def _score_numbers() -> str:
    """A number per rank (of 10,000) and percentage (of 1,000) from the balance."""
    return ", ".join(
        f"(cents + 99999) * {i + 1} % {10001 if name in C.RANKS else 1001} as number_{name}"
        for i, name in enumerate(C.VULNERABILITY_METRICS)
    )


def _scores() -> str:
    """Ranks and percentages as text tokens, with gaps and damage by key."""
    out = []
    for i, name in enumerate(C.VULNERABILITY_METRICS):
        unit, digits, outside = (10000, 4, "'1.25'") if name in C.RANKS else (10, 1, "'101'")
        v = f"number_{name}"
        text = f"printf('%d.%0{digits}d', {v} $div {unit}, {v} % {unit})"
        out.append(
            f"case (slot + {i}) % 37 when 0 then '-999' when 1 then ' -999 ' when 2 then null"
            f" when 5 then ' ' || {text} || ' ' else case"
            f" when (slot + {i}) % 37 = 3 and k % 20 = 0 then 'BROKEN'"
            f" when (slot + {i}) % 37 = 4 and k % 20 = 0 then {outside} else {text} end end"
            f" as {name.upper()}"
        )
    return ", ".join(out)


_MONTHS = "'JanFebMarAprMayJunJulAugSepOctNovDec'"


def _period(i: int) -> str:
    month = f"substr({_MONTHS}, cast(3 * ((k + {i}) % 12) + 1 as int), 3)"
    first = f"printf('%02d', 1 + k % 28) || {month} || cast(2019 + k % 3 as string)"
    last = f"cast(1 + k % 9 as string) || lower({month}) || cast(2022 + k % 3 as string)"
    return (
        f"case when (k + {i}) % 41 = 0 then {last} || '-' || {first}"
        f" when (k + {i}) % 43 = 0 then '31Feb2021-' || {last}"
        f" when (k + {i}) % 47 = 0 then '' else {first} || '-' || {last} end"
    )


def _code(i: int) -> str:
    return (
        f"case (k * 3 + {i}) % 14 when 7 then '199' when 8 then '201' when 9 then '258'"
        " when 10 then '260' when 11 then '281' when 12 then ' 001 '"
        f" else case when (k * 3 + {i}) % 14 = 13 and k % 5 = 0 then '999' else '001' end end"
    )


def _facility_columns() -> str:
    def money(offset: int) -> str:
        return f"printf('%d.%02d', (cents + {offset}) $div 100, (cents + {offset}) % 100)"

    columns = {
        "ccn": "ccn",
        "facility_name": "p_name",
        "address_line_1": "p_brand || ' Street'",
        "address_line_2": "''",
        "city": "p_type",
        "state": "chr(65 + p_size % 26) || 'X'",
        "zip_code": "printf('%05d', k % 100000)",
        "source_county": "p_type || ' County'",
        "telephone": "'000-000-0000'",
        "ownership_status": "case when k % 2 = 0 then 'Profit' else 'Non-Profit' end",
    }
    out = {header: columns[name] for name, header in C.FACILITY_IDENTITY}
    for i, (_, header) in enumerate(C.FACILITY_YES_NO):
        out[header] = (
            f"case (k + {i}) % 7 when 0 then 'Yes' when 1 then ' no ' when 2 then 'NO'"
            f" when 3 then 'yes' else case when (k + {i}) % 70 = 4 then 'Maybe' else 'No' end end"
        )
    out[C.CHAIN_HEADER] = "case when k % 3 = 0 then '' else p_brand end"
    out[C.STATIONS_HEADER] = (
        "case when k % 17 = 0 then '' when k % 19 = 0 then '4.6' when k % 23 = 0 then '-3'"
        " when k % 29 = 0 then 'abc' else cast(p_size as string) end"
    )
    out[C.CERTIFIED_HEADER] = (
        "case when k % 31 = 0 then '2020-01' when k % 37 = 0 then ''"
        " else printf('%04d-%02d-%02d', 2000 + k % 20, 1 + k % 12, 1 + k % 28) end"
    )
    out[C.STAR_HEADERS["period"]] = _period(0)
    out[C.STAR_HEADERS["rating"]] = "case when k % 6 = 0 and k % 4 = 0 then '' else cast(k % 6 as string) end"
    out[C.STAR_HEADERS["availability"]] = _code(0)
    for i, headers in enumerate(C.OUTCOME_HEADERS.values(), start=1):
        out[headers["period"]] = _period(i)
        out[headers["availability"]] = _code(i)
        out[headers["category"]] = (
            f"case (k + {i}) % 4 when 0 then 'Better Than Expected' when 1 then 'as expected'"
            f" when 2 then ' Worse than Expected ' else case when k % 9 = 0 then 'unknown'"
            " else 'As Expected' end end"
        )
        out[headers["denominator"]] = (
            f"case when (k + {i}) % 53 = 0 then '' when (k + {i}) % 59 = 0 then '12.5'"
            " else cast(p_size as string) end"
        )
        out[headers["estimate"]] = f"case when (k + {i}) % 67 = 0 then '' else {money(i * 100)} end"
        out[headers["lower_confidence_limit"]] = (
            f"case when (k + {i}) % 61 = 0 then {money(i * 100 + 250)} else {money(i * 100 - 500)} end"
        )
        out[headers["upper_confidence_limit"]] = money(i * 100 + 500)
    return ", ".join(f"{text} as ${{q}}{header}${{q}}" for header, text in out.items())


# name -> (relations it reads, SQL)
INPUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "order_quantity": (
        (),
        "select l_orderkey, sum(cast(l_quantity as bigint)) as qty,"
        " sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end) as ret"
        " from $lineitem group by l_orderkey",
    ),
    "activity": (
        ("order_quantity",),
        "select o_custkey as k, year(o_orderdate) as yr, count(*) as n,"
        " count_if(o_orderpriority = '1-URGENT') as urgent,"
        " count_if(o_orderpriority = '5-LOW') as low,"
        " count_if(o_orderpriority = '2-HIGH') as high,"
        " count_if(o_orderstatus = 'P') as partial,"
        " count_if(o_orderstatus = 'F') as done,"
        " cast(sum(coalesce(qty, 0)) as bigint) as qty,"
        " cast(sum(coalesce(ret, 0)) as bigint) as ret,"
        " cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents"
        " from $orders left join order_quantity on o_orderkey = l_orderkey"
        " group by o_custkey, year(o_orderdate)",
    ),
    "county": (
        (),
        f"select c_custkey as k, c_name, n_nationkey, n_name, {_STATE_CODE} as state,"
        f" {_STATE_LABEL} as label, cast(round(c_acctbal * 100) as bigint) as cents,"
        f" printf('%s%03d', {_STATE_CODE}, c_custkey) as code"
        " from $customer join $nation on c_nationkey = n_nationkey",
    ),
    "county_activity": (
        ("activity", "county"),
        "select county.k, c_name, n_nationkey, state, label, code, yr, n, urgent, low, high,"
        " partial, case when county.k % 173 = 0 then n + 1 else done end as done, qty, ret,"
        " activity.cents from activity join county on activity.k = county.k",
    ),
    "activity_levels": (
        ("county_activity",),
        f"select k, c_name, n_nationkey, state, label, code, yr,"
        f" grouping(k) + grouping(n_nationkey) as level, {_TOTALS} from county_activity"
        " group by grouping sets ((k, c_name, n_nationkey, state, label, code, yr),"
        " (n_nationkey, state, label, yr), (yr))",
    ),
    "medicare_rows": (
        ("activity_levels",),
        "select *, case level when 0 then k when 1 then n_nationkey end as noise, $each(case"
        " when level = 2 then $list('National', 'Territory')"
        " when level = 1 then $list('All')"
        " when k % 149 = 0 and k % 97 <> 0 then $list('All', 'All', '<65')"
        " when k % 5 = 0 then $list('All', '<65') else $list('All') end) as part"
        " from activity_levels",
    ),
    "medicare_texts": (
        ("medicare_rows",),
        "select k, c_name, state, label, code, yr, level, part, noise, noise * 7 + yr as slot, "
        + ", ".join(f"{text} as text_{name}" for name, text in _METRIC_TEXT.items())
        + " from medicare_rows",
    ),
    "raw_medicare": (
        ("medicare_texts",),
        "select cast(yr as string) as YEAR,"
        " case when level = 0 then 'County' when part = 'National' then 'National'"
        " else 'State' end as BENE_GEO_LVL,"
        " case level when 0 then label || case when k % 97 = 0 then '-UNKNOWN'"
        " else '-' || c_name end when 1 then label else part end as BENE_GEO_DESC,"
        " case level when 0 then case when k % 97 = 0 then state || '000'"
        " when k % 331 = 0 then '' else code end when 1 then state else '' end as BENE_GEO_CD,"
        " case when part = '<65' then part else 'All' end as BENE_AGE_LVL, "
        + ", ".join(
            f"{_noisy(f'text_{name}', 'noise', i)} as {name.upper()}"
            for i, name in enumerate(_METRIC_TEXT)
        )
        + f", {_lineage(C.MEDICARE, 'medicare', 'source_content_sha256')} from medicare_texts",
    ),
    "svi_rows": (
        ("county",),
        "select k, c_name, n_name, state, label, code, k * 5 as slot, $each(case when k % 151 = 0"
        f" then $list(1, 2) else $list(1) end) as copy, {_score_numbers()}"
        " from county where k % 97 <> 0 and k % 13 <> 0",
    ),
    "raw_vulnerability": (
        ("svi_rows",),
        f"select state as ST, n_name as STATE, label as ST_ABBR,"
        " case when k % 401 = 0 then 'ABCDE' else code end as STCNTY,"
        " case when k % 409 = 0 then ' ' else c_name end as COUNTY,"
        f" {_scores()}, cast(k + 1 as string) as GRASP_ID,"
        f" {_lineage(C.VULNERABILITY, 'vulnerability', 'source_snapshot_sha256')},"
        " k $div 2000 as source_page_index, k $div 2000 * 2000 as source_page_offset,"
        " $sha('page-' || cast(k $div 2000 as string)$bits) as source_page_sha256"
        " from svi_rows union all"
        " select '11', n_name, 'DC', '11001', 'District', "
        + ", ".join("'0.75'" if m == "rpl_themes" else "'0'" for m in C.VULNERABILITY_METRICS)
        + f", '0', {_lineage(C.VULNERABILITY, 'vulnerability', 'source_snapshot_sha256')},"
        " cast(0 as bigint), cast(0 as bigint), $sha('page-0'$bits)"
        " from $nation where n_nationkey = 4",
    ),
    "facility_rows": (
        (),
        "select p_partkey as k, case when p_partkey % 503 = 0 then '12345678901'"
        " when p_partkey % 401 = 0 then ' ' when p_partkey % 307 = 0 then 'X12'"
        " else printf('%06d', p_partkey) end as ccn, p_name, p_brand, p_type, p_size,"
        " cast(round(p_retailprice * 100) as bigint) as cents from $part",
    ),
    "raw_facility": (
        ("facility_rows",),
        f"select {_facility_columns()},"
        f" {_lineage(C.FACILITY, 'facility', 'source_snapshot_sha256', True)} from facility_rows",
    ),
    "historical": (
        ("county",),
        "select code as county_fips, state as state_fips, n_name as state_name,"
        " label as state_abbreviation, c_name as county_name,"
        " label || '-' || c_name as source_geography_description,"
        " cast(1995 as int) as observed_cms_start_year,"
        " cast(case when k % 5 = 0 then 1994 else 1999 end as int) as observed_cms_end_year,"
        " 'historical_source_only' as geography_status, false as is_current_county,"
        " case when k % 2 = 0 then null else 'boundary changed' end"
        f" as boundary_discontinuity_warning, '{C.HISTORICAL_VERSION}' as seed_version"
        " from county where k % 38 = 0",
    ),
}


# Tables of which every row becomes some hundred computed cells. They are a few MB in one
# file, which one task would read and compute, so their rows are dealt out before.
SPREAD = {"raw_vulnerability": ("customer",), "raw_facility": ("part",)}
SPREAD_TASKS = 32


def closure(names) -> list[str]:
    """The named inputs and everything they read, in definition order."""
    wanted = set(names)
    for name in reversed(INPUTS):
        if name in wanted:
            wanted |= set(INPUTS[name][0])
    return [n for n in INPUTS if n in wanted]


def _render(text: str, names: dict[str, str]) -> str:
    return Template(text).substitute(names)


def duckdb_ctes(names) -> list[str]:
    words = {t: t for t in TABLES} | {
        "div": "//", "sha": "sha256", "bits": "", "q": '"', "each": "unnest", "list": "list_value",
    }
    return [f"{n} as ({_render(INPUTS[n][1], words)})" for n in closure(names)]


def spark_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    words = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    words |= {t: f"(select /*+ REPARTITION({SPREAD_TASKS}) */ * from {words[t]})" for t in SPREAD.get(name, ())}
    words |= {
        "div": "div", "sha": "sha2", "bits": ", 256", "q": "`", "each": "explode", "list": "array",
    }
    ctes = ", ".join(f"{n} as ({_render(INPUTS[n][1], words)})" for n in closure([name]))
    return spark.sql(f"with {ctes} select * from {name}")
