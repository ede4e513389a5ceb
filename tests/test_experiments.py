import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from demandlab.plans.experiments import (
    add_difference,
    design_response,
    flag_exp6_higher,
    mean_by_timeframe,
    overall_mean,
    sum_by_timeframe,
)
from demandlab.sources.csv_files import read_anchor_days, read_design_matrix, read_indexed_csv, write_csv

COLUMNS = "timeframe int, product_id bigint, " + ", ".join(f"mafe_exp{k} double" for k in range(1, 9))
# The coded design, one row per experiment (a, b, c, d, af, bf, cf, df).
DESIGN = [
    (0, 0, 0, 0, -1, -1, -1, -1),
    (1, 0, 0, 1, 1, -1, -1, 1),
    (0, 1, 0, 1, -1, 1, -1, 1),
    (1, 1, 0, 0, 1, 1, -1, -1),
    (0, 0, 1, 1, -1, -1, 1, 1),
    (1, 0, 1, 0, 1, -1, 1, -1),
    (0, 1, 1, 0, -1, 1, 1, -1),
    (1, 1, 1, 1, 1, 1, 1, 1),
]


@pytest.fixture
def errors(spark):
    rows = [(2, 1, *[float(k) for k in range(1, 9)]), (2, 2, *[3.0 * k for k in range(1, 9)]), (3, 1, *[1.0] * 8)]
    return spark.createDataFrame(rows, COLUMNS)


def test_means_and_sums(errors):
    means = {r.timeframe: r for r in mean_by_timeframe(errors).collect()}
    assert (means[2].mafe_exp3, means[2].product_id, means[3].mafe_exp8) == (6.0, 1.5, 1.0)
    sums = {r.timeframe: r for r in sum_by_timeframe(errors).collect()}
    assert (sums[2].mafe_exp3, sums[2].product_id) == (12.0, 3)
    overall = overall_mean(add_difference(mean_by_timeframe(errors))).first()
    assert (overall.timeframe, overall.comp) == (2.5, 1.0)


def test_flag_marks_the_larger_error(errors):
    assert [r.exp6_higher for r in flag_exp6_higher(errors).orderBy("timeframe").collect()] == [1, 1, 0]


def test_design_matrix(errors):
    rows = design_response(mean_by_timeframe(errors).drop("product_id")).orderBy("experiment").collect()
    assert [r.y for r in rows] == [2.0 * k for k in range(1, 9)]
    assert [(r.a, r.b, r.c, r.d, r.af, r.bf, r.cf, r.df) for r in rows] == DESIGN


def test_csv_files(spark, errors, tmp_path):
    days = tmp_path / "days.csv"
    days.write_text(",date\n0,2022-08-01\n1,2022-08-07\n")
    frame = read_anchor_days(spark, str(days))
    assert [r.date for r in frame.collect()] == [dt.date(2022, 8, 1), dt.date(2022, 8, 7)]
    assert frame.dtypes == [("date", "date")]

    out = tmp_path / "design"
    design = design_response(mean_by_timeframe(errors).drop("product_id"))
    write_csv(design.select(F.col("experiment").alias("row"), "y", "a", "b", "c", "d", "af", "bf", "cf", "df"), str(out))
    back = read_design_matrix(spark, str(out)).collect()
    assert sorted(tuple(r)[1:] for r in back) == sorted(DESIGN)
    with open(glob.glob(f"{out}/part-*.csv")[0]) as file:
        assert next(csv.reader(file)) == ["row", "y", "a", "b", "c", "d", "af", "bf", "cf", "df"]


def test_every_file_of_a_folder_has_its_header_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",date\n0,2022-08-01\n")
    (tmp_path / "b.csv").write_text("row,date\n0,2022-08-02\n")
    assert read_anchor_days(spark, str(tmp_path)).count() == 2
    columns = "y double, a int"
    folder = tmp_path / "swapped"
    folder.mkdir()
    (folder / "a.csv").write_text("n,y,a\n0,1.5,2\n")
    (folder / "b.csv").write_text("n,a,y\n0,2,1.5\n")
    with pytest.raises(ValueError, match="b.csv has the columns a, y, not y, a"):
        read_indexed_csv(spark, str(folder), columns)
