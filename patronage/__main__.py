"""Command line: write the extract files from warehouse tables.

    python -m patronage --database dw --out /shared/extracts --params params.json
    python -m patronage --location /data/warehouse --out /data/out --format parquet

``params.json`` holds the institution's values: ``school_code``,
``class_segment`` ([first year, last year, label] or null),
``org_segment_labels`` and ``mail_labels`` (lists of [code, label], which may
be empty), all required, and optionally ``share_places`` and
``staff_exceptions``: objects with ``staff_cons_id`` and either ``years``
(exact texts) or ``scy_from`` and ``scy_to`` (numbers; offsets from the fiscal
year with ``"fiscal_year_relative": true``). The fiscal year is read from the
warehouse's parameter table.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from patronage.params import Params, StaffException, read_fiscal_year
from patronage.plans.jobs import FILES, write_extracts
from patronage.sources.warehouse import warehouse_tables


def load_params(path: str, fiscal_year: int) -> Params:
    with open(path) as fh:
        raw = json.load(fh)
    missing = [k for k in ("school_code", "class_segment", "org_segment_labels", "mail_labels") if k not in raw]
    if missing:
        raise ValueError(f"{path}: missing {', '.join(missing)}")
    rules = tuple(StaffException(**{**r, "years": tuple(r.get("years", ()))}) for r in raw.get("staff_exceptions", ()))
    return Params(fiscal_year=fiscal_year, school_code=raw["school_code"],
                  class_segment=tuple(raw["class_segment"]) if raw["class_segment"] else None,
                  org_segment_labels=tuple(map(tuple, raw["org_segment_labels"])),
                  mail_labels=tuple(map(tuple, raw["mail_labels"])), staff_exceptions=rules,
                  share_places=raw.get("share_places", 4))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="patronage")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--database", help="catalog database holding the warehouse tables")
    src.add_argument("--location", help="directory with one folder per warehouse table")
    ap.add_argument("--out", required=True)
    ap.add_argument("--params", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--parts", action="store_true", help="folders of part files instead of one csv file per extract")
    ap.add_argument("--files", nargs="*", choices=sorted(FILES))
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("patronage").getOrCreate()
    t = warehouse_tables(spark, location=args.location, database=args.database)
    p = load_params(args.params, read_fiscal_year(t.adv_reportvars_d))
    for name, path in write_extracts(spark, t, p, args.out, args.format, args.files,
                                     one_file=args.format == "csv" and not args.parts).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
