"""Scalar column functions on the edge strings of the raw listing format."""

from pyspark.sql import functions as F

from tidyrent.functions import numeric as N
from tidyrent.functions import text as T
from tidyrent.plans import format as fmt


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {dtype}")
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


def test_date_phrases_and_days(spark):
    vals = ["Publicado hoy", "Publicado desde ayer", "Publicado hace más de 1 año", "Publicado hace 25 minutos",
            "Publicado hace 3 horas", "Publicado hace 12 días", None]

    def pipe(c):
        c = T.replace_if_contains(T.map_phrases(c, T.DATE_PHRASES), T.MINUTES_WORD, T.MINUTES_VALUE)
        return T.parse_int(c, T.INT_PATTERNS["fecha_publicacion"])

    assert one_col(spark, vals, pipe) == [0, 1, 365, 0, None, 12, None]


def test_age_patterns(spark):
    vals = ["A estrenar", "12 años", "1 año", "Año de construcción\n2015", "sin dato", None]

    def pipe(c):
        c = T.keep_if_matches(T.replace_exact(c, T.NEW_BUILD_TEXT, T.NEW_BUILD_VALUE), T.KEEP_IF["antiguedad"])
        return T.parse_int(c, T.INT_PATTERNS["antiguedad"])

    # "1 año" (singular) gives no match, as in the source
    assert one_col(spark, vals, pipe) == [0, 12, None, 2015, None, None]


def test_prices_and_currency(spark):
    vals = ["S/ 3,500", "S/ 3.500", "US$1200", "US$ 1200", None, ""]
    tags = one_col(spark, vals, T.currency_tag)
    assert tags == ["S/ ", "S/ ", "US$", "US$", None, None]
    amounts = one_col(spark, vals, lambda c: T.parse_int(T.strip_separators(c), T.INT_PATTERNS["precio_soles"]))
    assert amounts == [3500, 3500, 1200, None, None, None]
    usd = one_col(spark, ["USD 1,000", "", None],
                  lambda c: T.parse_int(T.empty_to_null(T.strip_separators(c)), T.INT_PATTERNS["precio_dolares"]))
    assert usd == [1000, None, None]


def test_rooms_baths_area(spark):
    assert one_col(spark, ["3 dorm. ", "3 dorm", "2 baños"],
                   lambda c: T.parse_int(T.keep_if_matches(c, T.KEEP_IF["dormitorios"]),
                                         T.INT_PATTERNS["dormitorios"])) == [3, None, None]
    assert one_col(spark, ["2 baños", "1 baño", None],
                   lambda c: T.parse_int(c, T.INT_PATTERNS["banos"])) == [2, 1, None]
    assert one_col(spark, ["1 medio baño", "2 medios baños"],
                   lambda c: T.parse_int(c, T.INT_PATTERNS["banios/2"])) == [1, 2]
    assert one_col(spark, ["85 m² tot.", "85 tot."],
                   lambda c: T.parse_int(T.keep_if_matches(c, T.KEEP_IF["area_total"]),
                                         T.INT_PATTERNS["area_total"])) == [85, None]
    assert one_col(spark, ["1 estac.", None], lambda c: T.parse_int(c, T.INT_PATTERNS["estacionamiento"])) == [1, None]


def test_coordinate_pair(spark):
    df = spark.createDataFrame([("-12,1234", "-77.03"), (None, "-77,1"), ("-12,5", None), ("x", "-77")],
                               "la string, lo string")
    la, lo = T.parse_coordinate_pair(T.decimal_comma(F.col("la")), T.decimal_comma(F.col("lo")))
    assert [tuple(r) for r in df.select(la, lo).collect()] == [(-12.1234, -77.03), (None, None), (None, None),
                                                               (None, -77.0)]


def test_price_normalisation(spark):
    df = spark.createDataFrame([(1200, "US$", None), (None, None, 1000), (3500, "S/ ", 10), (None, None, None)],
                               "p long, m string, d long")
    got = [r[0] for r in df.select(N.normalise_price(F.col("p"), F.col("m"), F.col("d"))).collect()]
    assert got == [3.7 * 1200, 3.7 * 1000, 3500.0, None]


def test_spelling_age_and_bins(spark):
    assert one_col(spark, ["Chorillos", "CHORILLOS", "Barranco", None], N.fix_spelling) == \
        ["chorrillos", "chorrillos", "Barranco", None]
    assert one_col(spark, [2015, 12, None], N.year_to_age, "long") == [10, 12, None]
    # right-closed: 5.0 with cuts (-1, 5, 10] falls in group 1
    assert one_col(spark, [5.0, 5.5, 10.0, 11.0, None, -3.0],
                   lambda c: N.right_closed_bins(c, [-1, 5, 10]), "double") == \
        ["Grupo 1", "Grupo 2", "Grupo 2", "desconocido", "desconocido", "desconocido"]


def test_combo_key_and_decimal_repair(spark):
    df = spark.createDataFrame([(3.0, 1.0), (2.0, None)], "a double, b double")
    assert [r[0] for r in df.select(T.combo_key(F.col("a"), F.col("b"))).collect()] == ["3.0,1.0", "2.0,nan"]
    assert one_col(spark, ["-12.123.456", "1.234.567"], lambda c: T.decimal_point_repair(c, 3)) == \
        [-12.123456, 123.4567]


def test_reply_repair(spark):
    schema = "struct<id:bigint,area:double>"
    vals = ["```json\n[{'id': 1, 'area': None}, {'id': 2, 'area': 80}]\n```", "Resultado: {'id': 5, 'area': 3}",
            "no puedo", ""]
    got = one_col(spark, vals, lambda c: T.repair_reply(c, schema))
    assert [(r.id, r.area) for r in got[0]] == [(1, None), (2, 80.0)]
    assert [(r.id, r.area) for r in got[1]] == [(5, 3.0)]
    assert got[2] is None and got[3] is None


def test_haversine(spark):
    df = spark.createDataFrame([(-12.0, -77.0, -13.0, -77.0)], "a double, b double, c double, d double")
    km = df.select(N.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]
    assert abs(km - 111.19492664455873) < 1e-9


def test_format_listings_keeps_extra_columns(spark):
    raw = spark.createDataFrame(
        [(1, "d", "Publicado hoy", "A estrenar", "S/ 1,000", "", "-12,1", "-77,1", "2 dorm. ", "1 baño", None,
          "50 m² tot.", None, None, "Chorillos", "x")],
        "row_id long, descripcion string, fecha_publicacion string, antiguedad string, precio_soles string, "
        "precio_dolares string, latitud string, longitud string, dormitorios string, banos string, "
        "`banios/2` string, area_total string, area_cubierta string, estacionamiento string, distrito string, "
        "otra string")
    out = fmt.normalise_prices(fmt.format_listings(raw)).first().asDict()
    assert out["precio"] == 1000.0 and out["area"] == 50.0 and out["antiguedad"] == 0.0
    assert out["distrito"] == "chorrillos" and out["otra"] == "x" and out["latitud"] == -12.1
