"""Small source files and relations that the tests build the mart from."""

import csv
import hashlib
import json
import os

from pyspark.sql import functions as F

from plumbmart.sources import contracts as C
from plumbmart.sources.files import scan_csv
from plumbmart.sources.pages import scan_pages
from plumbmart.sources.seeds import historical_county_identities
from plumbmart.sources.sinks import build_input_audit, source_audit, with_lineage

STAMP = {"source_retrieved_at_utc": "2026-01-02T03:04:05Z", "source_modified_at": "2026-01-01"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def medicare_row(year, level, label, code, share="0.01", users="10", people="1000", age="All",
                 other="0.5"):
    metrics = {
        "benes_om_cnt": people, "benes_op_dlys_cnt": users, "benes_op_dlys_pct": share,
    }
    return [year, level, label, code, age] + [
        metrics.get(m, other) for m, _, _ in C.MEDICARE_METRICS
    ]


SCREENING_ROWS = [
    medicare_row("2023", "County", "CT-Old Shire", "09001", "0.015"),
    medicare_row("2023", "State", "CT", "09"),
    medicare_row("2023", "National", "National", "", "0.0073"),
    medicare_row("2024", "County", "AL-First", "01001", "0.02"),
    medicare_row("2024", "County", "AK-Second", "02013", "0.01"),
    medicare_row("2024", "State", "DC", "11", "0.01"),
    medicare_row("2024", "State", "AL", "01", "0.01"),
    medicare_row("2024", "State", "AK", "02", "0.0075"),
    medicare_row("2024", "National", "National", "", "0.0075"),
]


def county(code, label, rank, object_id, **scores):
    row = {"ST": code[:2], "STATE": f"State {code[:2]}", "ST_ABBR": label, "STCNTY": code,
           "COUNTY": f"County {code}"}
    row |= {m.upper(): 0.5 if m in C.RANKS else 10 for m in C.VULNERABILITY_METRICS}
    row |= {"RPL_THEMES": rank, "GRASP_ID": object_id}
    return row | scores


PAGES = {
    0: [county("01001", "AL", 0, 1), county("11001", "DC", 0.75, 2, RPL_THEME1=-999)],
    2: [county("02013", "AK", 1, 3, EP_AGE65=None)],
}


def facility_row(ccn, star=("4", "001"), outcomes=None, chain="Yes", stations="12"):
    row = {h: "text" for h in C.FACILITY_COLUMNS}
    row |= {h: "Yes" for _, h in C.FACILITY_YES_NO}
    row |= {
        C.CCN_HEADER: ccn, C.STATIONS_HEADER: stations, C.CERTIFIED_HEADER: "2020-01-02",
        C.FACILITY_YES_NO[0][1]: chain, C.STAR_HEADERS["period"]: "01Jan2021-31Dec2024",
        C.STAR_HEADERS["rating"]: star[0], C.STAR_HEADERS["availability"]: star[1],
    }
    for family, headers in C.OUTCOME_HEADERS.items():
        code, numbers = (outcomes or {}).get(family, ("001", ("100", "10.5", "9.0", "12.0")))
        values = ("01Jan2024-31Dec2024", code, "As Expected" if code == "001" else "", *numbers)
        row |= dict(zip(headers.values(), values, strict=True))
    return row


FACILITIES = [
    facility_row("012345"),
    facility_row("123456", ("", "201"), {"survival": ("201", ("",) * 4)}, "No", "0"),
    facility_row("654321", ("0", "258"), {"survival": ("001", ("20", "0", "0", "0"))}),
]


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)
    return path


def write_pages(path, pages):
    os.makedirs(path, exist_ok=True)
    for offset, rows in pages.items():
        body = {"features": [{"attributes": r} for r in rows], "exceededTransferLimit": False}
        with open(f"{path}/page-{offset:06d}.json", "w", encoding="utf-8") as out:
            json.dump(body, out)
    return path


def lineage(source, hash_name, label, **more):
    return {"source_id": source, "source_manifest_run_id": f"{label}-run",
            hash_name: sha(label), **STAMP, **more}


def raw_sources(spark, path, medicare=SCREENING_ROWS, pages=PAGES, facilities=FACILITIES):
    """Raw relations of a three-source build, read from files by the scans."""
    header = [*C.MEDICARE_COLUMNS, "EXTRA_NOTE"]
    m = scan_csv(
        spark, write_csv(f"{path}/medicare.csv", header, [[*r, "note"] for r in medicare]),
        C.MEDICARE_COLUMNS,
    )
    f = scan_csv(
        spark,
        write_csv(f"{path}/facility.csv", C.FACILITY_COLUMNS,
                  [[r[h] for h in C.FACILITY_COLUMNS] for r in facilities]),
        C.FACILITY_COLUMNS,
    )
    s = scan_pages(spark, write_pages(f"{path}/pages", pages), C.VULNERABILITY_COLUMNS)
    s = s.where("problem is null").select(
        *C.VULNERABILITY_COLUMNS,
        (F.col("page_offset") / 2).cast("bigint").alias("source_page_index"),
        F.col("page_offset").alias("source_page_offset"),
        F.col("page_sha256").alias("source_page_sha256"),
    )
    m = with_lineage(m, lineage(C.MEDICARE, "source_content_sha256", "medicare"))
    s = with_lineage(s, lineage(C.VULNERABILITY, "source_snapshot_sha256", "index"))
    f = with_lineage(
        f, lineage(C.FACILITY, "source_snapshot_sha256", "facility", source_release="2026-01")
    )
    audits = {
        "cms": source_audit(m, C.MEDICARE_CONTRACT, "source_content_sha256"),
        "svi": source_audit(s, C.VULNERABILITY_CONTRACT, "source_snapshot_sha256",
                            "source_page_index"),
        "facility": source_audit(f, C.FACILITY_CONTRACT, "source_snapshot_sha256"),
    }
    return {
        f"raw.{C.MEDICARE}": m.cache(),
        f"raw.{C.VULNERABILITY}": s.cache(),
        f"raw.{C.FACILITY}": f.cache(),
        f"raw.{C.FACILITY}_load_audit": f.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(F.col(f"`{C.CCN_HEADER}`")).alias("distinct_ccn_count"),
        ),
        "raw.build_input_audit": build_input_audit("sample-build", audits),
        "historical_county_identities": historical_county_identities(spark),
    }
