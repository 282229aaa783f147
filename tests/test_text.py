from pyspark.sql import functions as F

from sheafline.functions import text as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_scalars(spark):
    L = F.lit
    assert value(spark, X.clean_text(L("a  b "))) == "a b"
    assert value(spark, X.normalize_title(L("Warranty:"))) == "warranty "
    assert value(spark, X.match_form(L("Conservación / Garantía"))) == "conservacion garantia"
    assert value(spark, X.word_count(L("  "))) == 0
    assert value(spark, X.upper_ratio(L("12 -"))) is None
    assert value(spark, X.product_codes(L("Manual for B-CU-12 HM134 A-01"))) == "B-CU-12 | HM134 | A-01"
    assert value(spark, X.product_codes(L("A-01 A-02 A-03 A-04"))) is None
    assert value(spark, X.file_stem(L("a.b.pdf"))) == "a.b"
    assert value(spark, X.sanitize(L("a\x00b\n"))) == "ab\n"
    assert value(spark, X.clean_text(L(None).cast("string"))) is None


def test_labels(spark):
    flat = F.lit("Code: X1. Other; model - : ; ref: r9")
    found, values = X.labelled_values(flat, ["code", "model", "ref"])
    df = spark.range(1).select(found.alias("f"), values.alias("v"))
    get = lambda *labels: df.select(X.label_value(F.col("f"), F.col("v"), labels).alias("x")).first().x
    assert tuple(get("code")) == ("code", "X1")
    assert tuple(get("model", "ref")) == ("ref", "r9")
    assert get("sku") is None
    assert tuple(value(spark, X.origin_value(F.lit("Made in Italy, 2020")))) == ("Made in", "Italy")


def test_table_grid(spark):
    grid = X.table_grid(F.array(F.lit("a"), F.lit(None).cast("string")), F.array(F.array(F.lit("1"), F.lit("2")), F.lit(None).cast("array<string>")))
    assert value(spark, grid) == "a | \n" + "-" * 20 + "\n1 | 2"


def test_json_map(spark):
    for reply, want in (('```json\n{"a": "b"}\n```', {"a": "b"}), ('sure: {"a": 1} ok', {"a": "1"}), ("none", {}), (None, {}), ("", {})):
        assert value(spark, X.json_map(F.lit(reply).cast("string"))) == want
