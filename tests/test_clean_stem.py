from pyspark.sql import functions as F

from sifter.functions import clean as C
from sifter.functions.stem import stem_table, with_stem

PORTER = dict(
    caresses="caress", ponies="poni", ties="tie", caress="caress", cats="cat", feed="feed",
    agreed="agre", plastered="plaster", bled="bled", motoring="motor", sing="sing",
    conflated="conflat", troubled="troubl", sized="size", hopping="hop", tanned="tan",
    falling="fall", hissing="hiss", fizzed="fizz", failing="fail", filing="file", happy="happi",
    sky="sky", relational="relat", conditional="condit", rational="ration", valenci="valenc",
    hesitanci="hesit", digitizer="digit", conformabli="conform", radicalli="radic",
    differentli="differ", vileli="vile", analogousli="analog", vietnamization="vietnam",
    predication="predic", operator="oper", feudalism="feudal", decisiveness="decis",
    hopefulness="hope", callousness="callous", formaliti="formal", sensitiviti="sensit",
    sensibiliti="sensibl", triplicate="triplic", formative="form", formalize="formal",
    electriciti="electr", electrical="electr", hopeful="hope", goodness="good", revival="reviv",
    allowance="allow", inference="infer", airliner="airlin", gyroscopic="gyroscop",
    adjustable="adjust", defensible="defens", irritant="irrit", replacement="replac",
    adjustment="adjust", dependent="depend", adoption="adopt", homologou="homolog",
    communism="commun", activate="activ", angulariti="angular", homologous="homolog",
    effective="effect", bowdlerize="bowdler", probate="probat", rate="rate", cease="ceas",
    controll="control", roll="roll", generously="gener", running="run", flies="fli", dies="die",
    died="die", lying="lie", news="news", generalization="gener", oscillators="oscil", be="be",
    syzygy="syzygi", crying="cri", says="say", played="play", theology="theolog",
    geology="geolog", yyyy="yyyi")


def test_porter_pairs(spark):
    df = spark.createDataFrame([(k,) for k in PORTER], "token string")
    got = {r.token: r.stem for r in with_stem(df, "token").collect()}
    assert {k: got[k] for k in PORTER} == PORTER


def test_stem_table_distinct(spark):
    df = spark.createDataFrame([("runs",), ("runs",), ("running",)], "token string")
    got = sorted((r.token, r.stem) for r in stem_table(df, "token").collect())
    assert got == [("running", "run"), ("runs", "run")]


def _clean(spark, text, opts=C.DEFAULT):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(C.clean_text("t", opts).alias("c")).first().c


def test_cleaning_contract(spark):
    out = _clean(spark, "Visit https://x.org/a?b=1 or mail me@site.com, call 555-123-4567!")
    assert out == "visit <url> or mail <email> call <phone>"
    assert _clean(spark, "Prix: €5, naïve Straße — don't 😀 stop") == \
        "prix <cur><number> naive strasse dont stop"
    assert _clean(spark, "Line\none\t\ttwo  ") == "line one two"
    assert _clean(spark, None) == ""


def test_light_variant_keeps_urls_and_numbers(spark):
    assert _clean(spark, "See www.a.com 42 times!", C.LIGHT) == "see wwwacom 42 times"


def test_tokenize_no_empty(spark):
    df = spark.createDataFrame([("",), ("a  b",)], "t string")
    got = [r.tk for r in df.select(C.tokenize(C.clean_text("t")).alias("tk")).collect()]
    assert got == [[], ["a", "b"]]


def test_with_clean_equals_clean_text(spark):
    texts = ["a@b.co x", "http://q.r/s t", "plain", "", "mail x@y.org www.z.com 12"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    a = C.with_clean(df, "t", "c1").withColumn("c2", C.clean_text("t"))
    assert all(r.c1 == r.c2 for r in a.collect())
    assert a.filter(F.col("c1") != F.col("c2")).count() == 0


def test_skipped_steps_change_no_text(spark):
    """Steps that a text can't match are skipped; the currency class for Java holds the same characters."""
    marks = [chr(c) for c in [*range(1, 0xD800, 7), *range(0x20A0, 0x20C1), *range(0xFDF0, 0x10000)]] + list(C.CURRENCY_RE[1:-1])
    texts = [f"{m} a{m}1" for m in marks] + ["", None, "plain", "555-123-4567", "x@y.org", "a  b\t", "www.a.b/ß 7", "Ægir $3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for opts in (C.DEFAULT, C.LIGHT, C.CleanOptions(numbers=False)):
        every = F.coalesce("t", F.lit(""))
        for kind, a, b, _ in C._steps(opts):
            every = C._apply(every, kind, a, b)
        assert df.filter(~C.clean_text("t", opts).eqNullSafe(every)).collect() == []
    both = df.select(F.regexp_replace("t", C.CURRENCY_RE, "").alias("a"), F.regexp_replace("t", C.CURRENCY_CLASS, "").alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
