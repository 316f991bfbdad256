"""Encoded integers of the record bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions.avro_bytes import long_hex


def test_short_and_long_integers(spark):
    numbers = [0, 1, 63, 64, 127, 128, 8191, 8192, -1, -64, -65, 2**63 - 1, -(2**63), None]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long")

    def digits(n):
        folded, out = (n << 1) ^ (n >> 63), b""
        while folded >= 0x80:
            out, folded = out + bytes([folded & 0x7F | 0x80]), folded >> 7
        return (out + bytes([folded])).hex().upper()

    got = [r.h for r in frame.select(long_hex(F.col("n")).alias("h")).collect()]
    assert got == ["" if n is None else digits(n) for n in numbers]
    first = long_hex(F.col("n"))._jc.toString()
    assert first.startswith("CASE WHEN") and first.index("63") < first.index("concat_ws")
