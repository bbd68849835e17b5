from pyspark.sql import functions as F

from tidecast.functions.nested import flattened, leaves_of, setting_rows

SCHEMA = "`a.b` int, c struct<d: string, `e f`: struct<g: double, h: array<int>>>, m map<string, int>"


def test_every_leaf_has_its_dotted_key(spark):
    rows = [(1, (7, ("x", (0.5, [1, 2])), {"k": 1})), (2, (None, None, None)), (3, None)]
    df = spark.createDataFrame(rows, f"id int, s struct<{SCHEMA.replace(' int', ': int', 1).replace('c struct', 'c: struct').replace('m map', 'm: map')}>")
    flat = flattened(df, "s", ["id"])
    assert flat.columns == ["id", "a.b", "c.d", "c.e f.g", "c.e f.h", "m"]
    first = flat.orderBy("id").collect()
    assert tuple(first[0]) == (1, 7, "x", 0.5, [1, 2], {"k": 1})
    assert tuple(first[1])[1:] == tuple(first[2])[1:] == (None,) * 5
    told = setting_rows(df, "s", ["id"]).where("id = 1").collect()
    assert [(r["key"], r["value"]) for r in told] == [
        ("a.b", "7"), ("c.d", "x"), ("c.e f.g", "0.5"), ("c.e f.h", "[1,2]"), ("m", '{"k":1}'),
    ]
    assert [k for k, _ in leaves_of(df.schema["s"].dataType)] == flat.columns[1:]


def test_a_struct_without_fields_has_no_row(spark):
    df = spark.range(2).withColumn("s", F.struct())
    assert setting_rows(df, "s", ["id"]).count() == 0
    assert flattened(df, "s", ["id"]).columns == ["id"]
