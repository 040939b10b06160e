import pytest
from pyspark.sql import functions as F

from tokenloom.functions import tokens as T


def _one(spark, expr, data, schema):
    return spark.createDataFrame([data], schema).select(expr.alias("o")).first().o


@pytest.mark.parametrize("b", [b"", b"\x00", b"abc", bytes(range(256)), "h\u00e9\U0001F600".encode()])
def test_bytes_to_ids_is_list_of_bytes(spark, b):
    assert _one(spark, T.bytes_to_ids(F.col("b")), (bytearray(b),), "b BINARY") == list(b)


def test_u16le_round_trip(spark):
    ids = [1, 256, 50256, 65535, 0]
    data = b"".join(i.to_bytes(2, "little") for i in ids)
    assert _one(spark, T.bytes_to_ids(F.col("b"), 2), (bytearray(data),), "b BINARY") == ids
    back = _one(spark, T.ids_to_bytes(F.col("a"), 2), (ids,), "a ARRAY<INT>")
    assert bytes(back) == data


def test_ids_to_bytes_u8(spark):
    ids = list(range(256))
    assert bytes(_one(spark, T.ids_to_bytes(F.col("a")), (ids,), "a ARRAY<INT>")) == bytes(ids)


def test_tail_context(spark):
    f = lambda a, n: _one(spark, T.tail_context(F.col("a"), n), (a,), "a ARRAY<INT>")
    assert f([1, 2, 3], 5) == [1, 2, 3]
    assert f([1, 2, 3, 4, 5, 6], 4) == [3, 4, 5, 6]
    assert f([], 4) == []


@pytest.mark.parametrize("a,want", [([7, 1, 2], [7]), ([1, 2, 3], [1, 2, 3]),
                                    ([1, 7, 2, 7, 3], [1, 7]), ([], [])])
def test_truncate_at_stop(spark, a, want):
    assert _one(spark, T.truncate_at_stop(F.col("a"), 7), (a,), "a ARRAY<INT>") == want


def test_append_and_range_check(spark):
    assert _one(spark, T.append_token(F.col("a"), F.lit(9)), ([1],), "a ARRAY<INT>") == [1, 9]
    assert _one(spark, T.out_of_range(F.col("a"), 105), ([-1, 0, 104, 105, 300],), "a ARRAY<INT>") == 3


def test_decode_cut_character_is_replaced(spark):
    cut = "\u00e9a".encode()[:1] + b"a"
    got = _one(spark, T.decode_utf8(F.col("b")), (bytearray(cut),), "b BINARY")
    assert got == cut.decode("utf-8", errors="replace")


def test_uint16_streams_empty_and_odd(spark):
    import pytest
    from pyspark.sql import functions as F
    from tokenloom.functions.tokens import bytes_to_ids
    df = spark.createDataFrame([(bytearray(b""),), (bytearray(b"\x01\x02\xff\xff"),)], "b BINARY")
    assert [r.x for r in df.select(bytes_to_ids(F.col("b"), 2).alias("x")).collect()] == [[], [513, 65535]]
    odd = spark.createDataFrame([(bytearray(b"\x01"),)], "b BINARY")
    with pytest.raises(Exception, match="odd number of bytes"):
        odd.select(bytes_to_ids(F.col("b"), 2).alias("x")).collect()
