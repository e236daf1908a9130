import pytest
from pyspark.sql import functions as F

from casona.functions import html, text, urls


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Lomas del Sol #37 - RPM Real Estate", "Lomas del Sol #37"),
        ("Charming home in Tamarindo | Costa Rica", "Charming home in Tamarindo"),
        ("Houses in Lindora | For Sale | House for sale in Lindora Santa Ana", "House for sale in Lindora Santa Ana"),
        ("Villa Mar - Tamarindo, Costa Rica", "Villa Mar - Tamarindo"),
        ("Casa Azul - $329,000 - MLS.cr listing", "Casa Azul"),
        ("  Casa   Verde : 3 ", "Casa Verde"),
        ("Search the best... Home", "Home"),
        ("- | -", None),
        (None, None),
    ],
)
def test_clean_title(spark, raw, clean):
    assert one(spark, text.clean_title("s"), s=raw) == clean


def test_own_brand_is_a_parameter(spark):
    assert one(spark, text.clean_title("s", own_brands=["Casona"]), s="Villa Sol - Casona Realty") == "Villa Sol"


@pytest.mark.parametrize(
    "raw, decoded",
    [
        ("a &amp; b", "a & b"),
        ("&amp;#8211;", "–"),  # the ampersand is decoded first
        ("&#8220;x&#8221;", '"x"'),
        ("&#x48;&#105;", "Hi"),
        ("&#55357; &#99999999;", "&#55357; &#99999999;"),
        ("&eacute;", "&eacute;"),
        (None, ""),
    ],
)
def test_decode_entities(spark, raw, decoded):
    assert one(spark, text.decode_entities("s"), s=raw) == decoded


def test_description_needs_ten_characters(spark):
    assert one(spark, text.clean_description("s"), s="tiny") is None
    assert one(spark, text.clean_description("s"), s="a \n b   c d e f g") == "a b c d e f g"


def test_slug(spark):
    assert one(spark, text.build_slug("t", "l", "k"), t="Casa & Río, 100% – Plano!", l=None, k="x").startswith("casa-y-rio-100por-ciento-plano-")
    assert one(spark, text.build_slug("t", "l", "k"), t="", l=None, k="x").startswith("untitled-")
    long = one(spark, text.build_slug("t", "l", "k"), t="ab-" * 40, l=None, k="x")
    assert len(long.rsplit("-", 1)[0]) <= 60 and not long.rsplit("-", 1)[0].endswith("-")


@pytest.mark.parametrize("href,url", [
    ("a b.jpg", "https://example.com/Dir/a%20b.jpg"), ("ñ.png?x=á b#c d", "https://example.com/Dir/%C3%B1.png?x=%C3%A1%20b#c%20d"),
    ("?x='1'", "https://example.com/Dir/P%C3%A1gina.html?x=%271%27"), ("#<é>", "https://example.com/Dir/P%C3%A1gina.html?q=%221%22#%3C%C3%A9%3E"),
    ("/x{1}`日`", "https://example.com/x%7B1%7D%60%E6%97%A5%60"), ("..\\up\\a.png", "https://example.com/up/a.png"), ("a\n\tb%20c", "https://example.com/Dir/ab%20c"),
    ("//CDN.example.com/y z.jpg", "https://CDN.example.com/y z.jpg"), ("HTTP://Other.com/a b", "HTTP://Other.com/a b"), ("mailto:x@y.z", "mailto:x@y.z")])
def test_absolutize_encodes(spark, href, url):
    assert one(spark, urls.absolutize_url("h", "b"), h=href, b='HTTPS://Example.COM:443/Dir/Página.html?q="1"') == url


@pytest.mark.parametrize("base", ["", "no url", "https://", "/path/only", None])
def test_absolutize_without_a_page(spark, base):
    assert one(spark, urls.absolutize_url("h", F.col("b").cast("string")), h="a.png", b=base or "") == ""


@pytest.mark.parametrize(
    "href, base, url",
    [
        ("/a?x=1", "https://h.com/p/q?z=1#f", "https://h.com/a?x=1"),
        ("//cdn.x/y.jpg", "http://h.com/p", "http://cdn.x/y.jpg"),
        ("../i.jpg", "https://h.com/a/b/c", "https://h.com/a/i.jpg"),
        ("./i.jpg", "https://h.com/a/", "https://h.com/a/i.jpg"),
        ("x.jpg", "https://h.com", "https://h.com/x.jpg"),
        ("mailto:a@b.c", "https://h.com", "mailto:a@b.c"),
        ("x.jpg", "not a url", ""),
        (None, "https://h.com", ""),
    ],
)
def test_absolutize(spark, href, base, url):
    assert one(spark, urls.absolutize_url("h", "b"), h=href, b=base) == url


def test_photo_dedupe_keeps_first_spelling_and_order(spark):
    given = [
        "https://i.com/a.jpg?w=100", "https://i.com/b.jpg", "https://i.com/a.jpg?Width=900&id=", "https://i.com/a.jpg?H=2",
        "https://i.com/500x500/b.jpg", "https://i.com/w_640/b.jpg?auto=1",
    ]
    kept = spark.createDataFrame([(given,)], "u array<string>").select(urls.dedupe_photo_urls("u")).first()[0]
    assert kept == [given[0], given[1], given[2]]


PAGE = """<html><head><title>T &amp; x</title><meta property="og:title" content="one"><meta content='two &amp; more' property='og:title'>
<meta name="description" content="D"><!-- <meta property="og:title" content="hidden"> --><script>var m = '<meta property="og:title" content="no">'</script>
<script type="application/ld+json">{"@graph":[{"@type":"Place","name":"p"},{"@type":["X","house"],"image":["u1",{"url":"u2"},{"no":1}]}]}</script>
<script type='application/ld+json'>[{"@type":"B"}, 3, null]</script><script type="application/ld+json">{broken</script></head>
<body><h1 class="t"> H <b>1</b></h1><img src="" data-src="z.png"><img src=q.jpg></body></html>"""


def test_structured_data(spark):
    df = spark.createDataFrame([(PAGE,)], "html string").select("html", html.extract_json_ld("html").alias("ld"), html.extract_open_graph("html").alias("og"))
    row = df.select(
        F.transform("ld", lambda v: F.array_join(html.entity_types(v), ",")).alias("types"), "og",
        html.entity_images(html.main_entity("ld", ["HOUSE"])).alias("images"), html.page_title("html", "og").alias("title"),
        html.page_title("html", F.lit(None).cast("map<string,string>")).alias("h1"), html.page_description("html", "og").alias("description"),
        html.image_urls("html").alias("imgs"),
    ).first()
    assert row.types == ["Place", "X,house", "", "B"]
    assert row.og == {"og:title": "two & more"} and row.title == "two & more" and row.h1 == "H 1"
    assert row.images == ["u1", "u2"] and row.description == "D" and row.imgs == ["z.png", "q.jpg"]


@pytest.mark.parametrize(
    "prose, expected",
    [
        ("3 bedrooms, 2.5 baths, 180m² lot, 95m² house, USD 350,000", (3, 2.5, 2, 1, 95, 180, 350000, "USD")),
        ("4 habitaciones, 3 baños, medio baño, terreno de 1,200 m2, construcción de 210 m2, ₡270,000,000", (4, 3.5, 3, 1, 210, 1200, 270000000, "CRC")),
        ("2 full + 1 half bath, 1500 sqft on 2 acres lot, $99,000.50", (None, 2.5, 2, 1, 139.35, 8093.72, 99000.5, "USD")),
        ("no facts", (None, None, None, None, None, None, None, None)),
    ],
)
def test_extract_facts(spark, prose, expected):
    f = one(spark, text.extract_facts("s"), s=prose)
    got = (f.bedrooms, f.bathrooms, f.bathrooms_full, f.bathrooms_half, f.interior_sqm, f.lot_sqm, f.price, f.price_currency)
    assert tuple(float(x) if x is not None and not isinstance(x, str) else x for x in got) == tuple(
        float(x) if isinstance(x, (int, float)) else x for x in expected)
