"""CSV by header."""

import pytest

from demandspark.sources import tables
from demandspark.sources.tables import read_training_csv


def test_schema_goes_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a,c\n1,2,z\n")
    rows = read_training_csv(spark, str(tmp_path / "x.csv"), "a int, b int").collect()
    assert [r.asDict() for r in rows] == [{"a": 2, "b": 1}]
    with pytest.raises(ValueError, match="no column d"):
        read_training_csv(spark, str(tmp_path / "x.csv"), "a int, d int")


def test_bad_cell_raises(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\nx\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_training_csv(spark, str(tmp_path / "x.csv"), "a int").collect()


def test_training_set_comes_back_with_its_types(spark, tmp_path):
    rows = [(1, "007", 2.5), (2, "12", None), (3, None, 0.0)]
    df = spark.createDataFrame(rows, "id int, city_destination string, v double")
    tables.write_training_set(df, str(tmp_path / "set"))
    back = tables.read_training_set(spark, str(tmp_path / "set"), df.schema)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == rows
