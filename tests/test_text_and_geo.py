import math

from pyspark.sql import functions as F

from tandem.functions import text as T
from tandem.functions.geo import polygon_area_m2, ring_area_km2, ring_area_m2


def test_contains_ci_and_null(spark):
    df = spark.createDataFrame([("a, food_quality",), ("FOOD_QUALITY",), (None,), ("other",)], "r string")
    got = [r.c for r in df.select(T.contains_ci(F.col("r"), "FOOD_QUALITY").alias("c")).collect()]
    assert got == [True, True, None, False]


def test_contains_ci_on_other_forms_of_the_same_text(spark):
    """Against the compatibility form with full case folding."""
    rows = [("ﬁnal", "FINAL"), ("oﬃce", "fic"), ("Straße", "STRASSE"), ("STRASSE", "straße"), ("ＦＯＯＤ＿ＱＵＡＬＩＴＹ", "FOOD_QUALITY"),
            ("cafe\u0301 x", "café"), ("café", "cafe\u0301"), ("cafe", "café"), ("café", "cafe"), ("xcafe\u0301", "cafe"), ("ﾄｶﾞ", "ガ"),
            ("x² and ½", "1⁄2"), ("Å", "å"), ("no\u00a0break", "no break"), ("ΣΑΣ", "σας"), ("", ""), ("abc", ""), ("a-b", "ab"), ("№ 5", "no 5")]
    df = spark.createDataFrame(rows, "t string, w string")
    for text, word in rows:
        got = df.where((F.col("t") == F.lit(text)) & (F.col("w") == F.lit(word))).select(T.contains_ci(F.col("t"), word).alias("c")).first().c
        assert got == (T.folded(word) in T.folded(text)), (text, word)


def test_mcdonalds_literal_and_pattern(spark):
    df = spark.createDataFrame([("McDonald%s", "x"), ("McDonalds", "x"), (None, "McDonalds Dublin"),
                                (None, "McDonaldSUPPLIER"), (None, None)], "g string, n string")
    got = [r.m for r in df.select(T.is_mcdonalds(F.col("g"), F.col("n")).alias("m")).collect()]
    assert got == [1, 0, 1, 0, 0]


def test_token_count_and_uuid_extract(spark):
    u1, u2 = "0123abcd-0000-1111-2222-333344445555", "89abcdef-0000-1111-2222-333344445555"
    df = spark.createDataFrame([(f"COLLECT:{u1};COLLECT:{u2}",), (f"COLLECT:{u1}",), ("",)], "j string")
    rows = df.select(T.token_count(F.col("j"), T.COLLECT_TOKEN).alias("n"),
                     T.extract_all(F.col("j"), T.UUID_PATTERN).alias("u")).collect()
    assert [r.n for r in rows] == [2, 1, 0]
    assert [r.u for r in rows] == [[u1, u2], [u1], []]


def test_ring_area(spark):
    ring = [(0.0, 40.0), (0.1, 40.0), (0.1, 40.1), (0.0, 40.1), (0.0, 40.0)]
    df = spark.createDataFrame([([{"lon": a, "lat": b} for a, b in ring],)],
                               "p array<struct<lon:double,lat:double>>")
    area = df.select(ring_area_km2(F.col("p")).alias("a")).first().a
    # 0.1 deg x 0.1 deg at 40 N is about 8.5 km x 11.1 km
    assert 94.0 < area < 96.0


POINTS = "array<struct<lon:double,lat:double>>"


def _ring(*corners):
    return [{"lon": float(a), "lat": float(b)} for a, b in (*corners, corners[0])]


def test_ring_area_has_great_circle_edges(spark):
    """Octants, a pole's cap cut to a triangle, the smaller side, the 180th meridian."""
    octant = 4 * math.pi * 6371010.0 ** 2 / 8
    rings = {"octant": _ring((0, 0), (90, 0), (0, 90)), "turned": _ring((0, 90), (90, 0), (0, 0)),
             "moved": _ring((150, 0), (-120, 0), (7, 90)), "south": _ring((0, 0), (90, 0), (45, -90)),
             "round the pole": _ring((0, 0), (120, 0), (-120, 0)), "line": _ring((0, 0), (1, 1))}
    df = spark.createDataFrame(list(rings.items()), f"n string, p {POINTS}")
    got = {r.n: r.a for r in df.select("n", ring_area_m2(F.col("p")).alias("a")).collect()}
    for name in ("octant", "turned", "moved", "south"):
        assert abs(got[name] / octant - 1) < 1e-9, name
    assert abs(got["round the pole"] / (4 * octant) - 1) < 1e-9 and got["line"] is None


def test_polygon_area_with_holes_and_parts(spark):
    square = lambda x, y, a: _ring((x, y), (x + a, y), (x + a, y + a), (x, y + a))
    shell, hole, far, round_pole = square(10, 40, 1.0), square(10.25, 40.25, 0.5), square(-30, -5, 0.5), _ring((0, 80), (90, 80), (180, 80), (-90, 80))
    polygons = {"a": [[shell]], "b": [[hole]], "c": [[far]], "p": [[round_pole]], "hole": [[shell, hole]], "all": [[shell, hole], [far], [round_pole]],
                "none": [], "empty part": [[], [far]], "null": None, "backwards": [[shell, hole[::-1]]]}
    df = spark.createDataFrame(list(polygons.items()), f"n string, p array<array<{POINTS}>>")
    got = {r.n: r.a for r in df.select("n", polygon_area_m2(F.col("p")).alias("a")).collect()}
    close = lambda x, y: abs(x / y - 1) < 1e-9
    assert close(got["hole"], got["a"] - got["b"]) and close(got["backwards"], got["hole"])
    assert close(got["all"], got["a"] - got["b"] + got["c"] + got["p"]) and close(got["empty part"], got["c"])
    assert got["none"] == 0 and got["null"] is None and 0 < got["p"] < 4e12
