"""The end-to-end job: all seven files written and readable."""

import csv
import glob
from collections import Counter

from pyspark.sql import functions as F

from patronage.plans.jobs import FILES, write_extracts
from patronage.plans.registry import fixture_params
from patronage.plans import extracts
from patronage.sources.testdata import testdata_tables as derive_tables


def test_write_all_extracts_as_csv(spark, tmp_path):
    t = derive_tables(spark, "/root/testdata/sf0.001")
    p = fixture_params(t)
    written = write_extracts(spark, t, p, str(tmp_path), "csv")
    assert set(written) == set(FILES)
    for name, path in written.items():
        back = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        fn, _ = FILES[name]
        want = fn(t, p)
        assert back.columns == want.columns
        text = want.select(*[F.col(f"`{c}`").cast("string") for c in want.columns])
        # an empty text and NULL are the same empty field
        rows = Counter(tuple(v or None for v in r) for r in text.collect())
        assert Counter(map(tuple, back.collect())) == rows, name
    header = next(csv.reader(open(sorted(glob.glob(f"{written['gift']}/part-*.csv"))[0])))
    assert header == ["Constituent_Externalid", "Gift_Amount", "Gift_Type", "Gift_Allocation", "Gift_Year",
                      "Gift_TransactionId", "Gift_Date"]


def test_shared_population_gives_the_same_rows(spark):
    from patronage.plans.jobs import shared_population
    t = derive_tables(spark, "/root/testdata/sf0.001")
    p = fixture_params(t)
    pop = shared_population(spark, t, p)
    for fn in (extracts.gift_summary_extract, extracts.relative_extract):
        assert sorted(fn(t, p, pop).collect()) == sorted(fn(t, p).collect())


def test_params_file_round_trip():
    from patronage.__main__ import load_params
    from patronage.plans.registry import (FIXTURE_CLASS_SEGMENT, FIXTURE_MAIL_LABELS, FIXTURE_ORG_LABELS,
                                          FIXTURE_STAFF_EXCEPTIONS)
    import os
    here = os.path.dirname(os.path.abspath(__file__))
    p = load_params(os.path.join(here, "..", "examples", "params.example.json"), 2000)
    assert p.fiscal_year == 2000 and p.school_code == "000100"
    assert p.staff_exceptions == FIXTURE_STAFF_EXCEPTIONS
    assert p.org_segment_labels == FIXTURE_ORG_LABELS and p.mail_labels == FIXTURE_MAIL_LABELS
    assert p.class_segment == FIXTURE_CLASS_SEGMENT


def test_params_file_needs_its_labels(tmp_path):
    import pytest

    from patronage.__main__ import load_params
    (tmp_path / "p.json").write_text('{"school_code": "1", "class_segment": null, "mail_labels": []}')
    with pytest.raises(ValueError, match="org_segment_labels"):
        load_params(str(tmp_path / "p.json"), 2000)


def test_csv_keeps_blanks_quotes_newlines_and_nulls(spark, tmp_path):
    from patronage.sources.sinks import write_extract
    rows = [(1, " Smith"), (2, "First "), (3, 'Jo "JJ" Lee'), (4, "a,b"), (5, "two\nlines"), (6, None), (7, '"'), (8, "back\\slash"), (9, "#x")]
    write_extract(spark.createDataFrame(rows, "k int, v string"), str(tmp_path / "f"))
    back = []
    for f in glob.glob(str(tmp_path / "f" / "part-*.csv")):
        with open(f, newline="") as fh:
            back += [(int(k), v or None) for k, v in list(csv.reader(fh))[1:]]
    assert sorted(back) == rows


def test_checkpoint_dir_comes_from_the_session(spark):
    from patronage.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_command_line_writes_every_file(spark, tmp_path, capsys):
    import os

    from patronage.__main__ import main
    from patronage.tables import TABLE_NAMES
    t = derive_tables(spark, "/root/testdata/sf0.001")
    loc = tmp_path / "warehouse"
    for name in TABLE_NAMES:
        t[name].write.parquet(str(loc / name))
    here = os.path.dirname(os.path.abspath(__file__))
    main(["--location", str(loc), "--out", str(tmp_path / "out"),
          "--params", os.path.join(here, "..", "examples", "params.example.json")])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert set(printed) == set(FILES)
    assert all(os.path.isfile(path) and path.endswith(f"{name}.csv") for name, path in printed.items())
    for name, path in printed.items():
        assert spark.read.option("header", True).csv(path).count() == FILES[name][0](
            t, fixture_params(t)).count(), name
