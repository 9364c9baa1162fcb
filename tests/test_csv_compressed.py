"""CSV files in compressed form."""

import glob

from helpers import rows_of

from ordermart.sources.files import NULL_TEXT, read_csv_as, write_csv


def test_compressed_csv_keeps_nulls_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x\ny, \"q\""), (2, "", "\\N?"), (3, " b ", None)], "n int, a string, b string")
    path = write_csv(df, str(tmp_path / "out"), NULL_TEXT, "gzip")
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    assert rows_of(read_csv_as(spark, path, df)) == rows_of(df)
