"""Pages of the known form, with their odd cases."""

import pytest
from pyspark.sql import functions as F

from carledger.functions import text as X
from carledger.operators import extract as E
from carledger.plans.pipeline import extract_and_split
from carledger.schema import RAW_COLUMNS

PAGE = """<html><div class="car-box"><h3 class="car-brand-name">A  2021款 x1 plus</h3>
<div class="brand-price-item"><span class="price">￥12.34万</span><span class="price-nom">新车含税价：20.00万</span></div></div>
<div class="all-basic-content"><ul class="basic-item-ul">
<li><span class="item-name">上牌&nbsp;时间：</span>2021年03月</li>
<li><span class="item-name">燃油标号</span>92号</li><li><span class="item-name">排量</span></li></ul></div></html>"""


def pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id int, html string")


def one(spark, html):
    return E.page_parts(pages(spark, html)).collect()[0]


def listing(spark, html):
    got = E.listings(E.page_parts(pages(spark, html))).collect()
    return got[0].asDict() if got else None


def test_whole_page(spark):
    got = listing(spark, PAGE)
    want = dict.fromkeys(RAW_COLUMNS, "")
    want.update(
        brand="A",
        style="2021款",
        model="x1 plus",
        current_price="12.34万",
        new_price="20.00万",
        fuel_type="汽油",
        reg_time="2021年03月",
        page_id=0,
    )
    assert got == want
    assert one(spark, PAGE).profile == {"上牌时间": "2021年03月", "燃油标号": "92号"}


def test_links(spark):
    html = (
        '<a href="/no">n</a><li class="x cards-li"><a class="q" href="/1&amp;2">a</a><a href="">b</a><a name="z">c</a></li>'
        '<li class="cards-li-not"><a href="/no"></a></li><li class="cards-li"><a href="/3"></a><a href="/3"></a></li>'
    )
    got = E.links(pages(spark, html), "https://h").collect()
    assert [(r.pos, r.link) for r in got] == [(0, "https://h/1&2"), (1, "https://h/3"), (2, "https://h/3")]
    assert E.links(pages(spark, html), card_class=None).count() == 5


def profile_of(spark, items, **options):
    html = f'<div class="all-basic-content"><ul class="basic-item-ul">{items}</ul></div>'
    return pages(spark, html).select(E.profile(F.col("html"), **options).alias("p")).collect()[0].p


@pytest.mark.parametrize(
    "items, want",
    [
        ('<li><i class="item-name">k</i>1</li><li><i class="item-name">k</i>2</li>', {"k": "2"}),
        ('<li><i class="item-name">k</i>1</li><li><i class="item-name">k</i> </li>', {"k": "1"}),
        ('<li>no name</li><li><i class="item-name"> </i>v</li>', {}),
        ('<li><i class="item-name">k</i>akbkc</li>', {"k": "abc"}),
        ('<li><i class="item-name">k</i> a <b> b </b> c </li>', {"k": "abc"}),
        ('<li class="z"><i class="a item-name b">k：</i>a &lt;b&gt; &amp;amp;</li>', {"k": "a <b> &amp;"}),
        ('<li><i class="item-name">&nbsp;k k&nbsp;</i>　v </li>', {"kk": "v"}),
        ('<li><i class="item-name-x">k</i>v</li>', {}),
    ],
)
def test_profile(spark, items, want):
    assert profile_of(spark, items) == want


def test_profile_keys_without_any_blank(spark):
    items = '<li><i class="item-name">a\tb　c</i>v</li>'
    assert profile_of(spark, items) == {"a\tb　c": "v"}
    assert profile_of(spark, items, all_blanks=True) == {"abc": "v"}


def test_profile_outside_of_the_section_is_ignored(spark):
    html = '<ul class="basic-item-ul"><li><i class="item-name">k</i>v</li></ul>'
    assert pages(spark, html).select(E.profile(F.col("html")).alias("p")).collect()[0].p == {}
    assert E.profile_rows(pages(spark, html)).count() == 0


@pytest.mark.parametrize(
    "title, want",
    [
        ("A", ("A", "", "")),
        (" A\n 2021款 ", ("A", "2021款", "")),
        ("A 2021款 x  y　z", ("A", "2021款", "x y z")),
        ("A\xa0B", ("A", "B", "")),
    ],
)
def test_title(spark, title, want):
    row = spark.createDataFrame([(title,)], "t string").select(
        X.title_brand(F.col("t")), X.title_style(F.col("t")), X.title_model(F.col("t"))
    )
    assert tuple(row.collect()[0]) == want


@pytest.mark.parametrize(
    "text, want",
    [("价：1万", "1万"), ("a: b :c", "b"), (" 1万 ", "1万"), ("价：", ""), ("", ""), (None, "")],
)
def test_new_price(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(X.new_price_text(F.col("t"))).collect()[0]
    assert row[0] == want


def test_price_text(spark):
    df = spark.createDataFrame([("￥1.5万",), ("¥2万万",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.price_text(F.col("t"))).collect()] == ["1.5万", "2万", "万", None]


def test_fallbacks_and_rejects(spark):
    crumbs = '<div class="bread-crumbs"><p class="content"><a>x</a><a>B 2020款</a></p></div>'
    card = '<div class="cxc-priceCard"><p class="left-module"><b class="goodstartmoney">3万</b></p></div>'
    box = '<div class="car-box"><h3 class="car-brand-name"> </h3></div>'
    good, bad = extract_and_split(pages(spark, crumbs + card, crumbs, card, box + crumbs + card, None))
    assert [(r.page_id, r.brand, r.current_price, r.new_price, r.fuel_type) for r in good.collect()] == [
        (0, "B", "3万", "", "电动")
    ]
    reasons = {r.page_id: r.reason for r in bad.collect()}
    assert reasons == {1: "no price", 2: "no title", 3: "empty title", 4: "no title"}


def test_frontier(spark):
    provinces = spark.createDataFrame([("p", "u?x=1"), ("q", "v?x=2")], "name string, base_url string")
    got = E.frontier(provinces, 3).orderBy("name", "page").collect()
    assert [r.url for r in got][:3] == ["u?x=1&page=1", "u?x=1&page=2", "u?x=1&page=3"] and len(got) == 6
    assert E.frontier(provinces).count() == 200


def test_a_part_ends_with_its_element(spark):
    card = '<div class="cxc-priceCard"><p class="left-module"><b class="goodstartmoney">12.00</b></p></div>'
    similar = '<div class="similar"><p class="brand-price-item"><span class="price">9.99</span></p></div>'
    box = '<div class="car-box"><h3 class="car-brand-name">A</h3></div>'
    assert one(spark, box + card + similar).price == "12.00"
    inner = '<div class="car-box"><p class="brand-price-item"><span class="price"><b><span>9</span>.99</b></span></p></div>'
    assert one(spark, inner).price == "9.99"
    section = '<div class="all-basic-content"><ul class="basic-item-ul"><li><i class="item-name">k</i>v</li></ul></div>'
    other = '<ul class="basic-item-ul"><li><i class="item-name">k</i>AD</li></ul>'
    assert one(spark, section + other).profile == {"k": "v"}


def test_other_spellings_of_markup(spark):
    box = "<DIV CLASS='a car-box'><H3 class=car-brand-name>A&#65;&nbsp;B</H3><p class='brand-price-item'>"
    box += "<I class='price-nom'>20</i><span class=price>&yen;12.34&#19975;</span></DIV>"
    found = one(spark, box)
    assert (found.title, found.price, found.new_price) == ("AA\xa0B", "¥12.34万", "20")
    assert listing(spark, box)["current_price"] == "12.34万"
    section = "<section class='all-basic-content'><UL class=basic-item-ul><LI><i class='item-name'>k<li><b class=item-name>l</b>w</UL></section>"
    assert one(spark, section).profile == {"l": "w"}
    card = "<LI class='cards-li'><A HREF='/1?a&amp;b'>x</A><a href=/2>y</a><a href=''>z</a></LI><a href='/3'></a>"
    assert [r.link for r in E.links(pages(spark, card), "h").collect()] == ["h/1?a&b", "h/2"]
    assert [r.link for r in E.links(pages(spark, card), "h", card_class=None).collect()] == ["h/1?a&b", "h/2", "h/3"]


def test_nested_items_and_sections(spark):
    items = '<li><i class="item-name">a</i>1<ul><li><i class="item-name">b</i>2</li></ul></li>'
    assert profile_of(spark, items) == {"b": "2", "a": "1b2"}
    cards = '<div class="cards-li"><a href="/1"></a><div class="cards-li"><a href="/2"></a></div></div>'
    assert [r.link for r in E.links(pages(spark, cards)).collect()] == ["/1", "/2"]


ODD_LINKS = (
    '<a data-href="/wrong" href="/right">a</a><a title="x > y href=\'/no\'" href="/q">b</a><!-- <a href="/comment"> -->'
    "<script>\"<a href='/script'>\"</script><style><a href=/style></style><A\nHREF='/v'>c</A><a x=1 href=/u/w?a=b>d</a>"
    '<a href="/n&eacute;&#233;&#xE9;&notin;x&copy=1&amp;y">e</a><a href="">f</a><a href="/1" href="/2">g</a><abbr href="/not">h</abbr>'
    "<a/href=/s>i</a><a hreflang='x'>j</a>"
)
ODD_TARGETS = ["/right", "/q", "/v", "/u/w?a=b", "/néééé∉x&copy=1&y".replace("éééé", "ééé"), "/1", "/s"]


def test_links_with_odd_attributes(spark):
    card = f'<li class="cards-li">{ODD_LINKS}</li>'
    for found in (E.links(pages(spark, ODD_LINKS), card_class=None), E.links(pages(spark, card))):
        assert [r.link for r in found.orderBy("pos").collect()] == ODD_TARGETS


def test_attributes_with_longer_names_choose_nothing(spark):
    html = (
        '<div data-class="car-box"><h3 class="car-brand-name">not in a box</h3></div><div title=\'class="car-box"\'><h3 class="car-brand-name">nor here</h3></div>'
        '<div class="car-box" class="x"><p data-class="car-brand-name">wrong</p><h3 x="a>b" CLASS=car-brand-name>B 2020款 right</h3>'
        '<div class="brand-price-item"><span aria-class="price">1万</span><span class="price">2万</span></div></div>'
    )
    got = one(spark, html)
    assert (got.title, got.price) == ("B 2020款 right", "2万")


def test_profile_alone_is_what_the_whole_walk_finds(spark):
    both = pages(spark, PAGE).select(E.profile(F.col("html")).alias("p"))
    assert both.collect()[0].p == one(spark, PAGE).profile


def test_pages_of_equal_tags_share_one_walk():
    from carledger.operators import pagewalk

    form = E.FORM._replace(card="", title=("car-box", "plan-of-this-test"))
    page = '<div class="car-box"><h3 data-x="a > b" class="plan-of-this-test">{0}</h3></div><a href="/{0}">1 > {0}</a><ul>{1}</ul>'
    titles = [pagewalk.walk(page.format(f"t{k} &amp; co", "<li>x"), form).title() for k in range(50)]
    assert titles == [f"t{k} & co" for k in range(50)]
    assert len(pagewalk._TAGS[form].plans) == 1
    # What angle brackets don't tell: tags in comments, scripts and quotes, text that looks like a tag.
    odd = ["<!-- <li> -->", "<script>'<li>'</script>", '<b title="<li>">', "a < b <li>", "<b", "<p x='>", '<i"x>', "<a <b>"]
    assert [pagewalk.walk(page.format("t", o), form).title() for o in odd] == ["t"] * len(odd)
    assert pagewalk.walk(f"a > b < {odd[0]}{page.format('t', '')} > ", form).title() == "t"


def test_parts_not_asked_for_are_not_taken(spark):
    html = pages(spark, PAGE, PAGE.replace("price", "other"), "", None)
    for parts in (["price"], ["new_price", "title"], ["profile"]):
        got = E.page_parts(html, parts)
        assert got.columns == ["page_id", *parts]
        assert got.collect() == E.page_parts(html).select("page_id", *parts).collect()
    assert E.rejects(E.page_parts(html, ["title", "price"])).collect() == E.rejects(E.page_parts(html)).collect()


def test_tags_of_a_page_like_another_are_not_read_again():
    from carledger.operators import pagewalk

    form = E.FORM._replace(card="", title=("car-box", "spelled-in-this-test"))
    page = '<div class="car-box"><h3 data-x="a > b" class="spelled-in-this-test">{}</h3></div>'
    assert pagewalk.walk(page.format("t"), form).title() == "t"
    pagewalk._TAGS[form].plan = None  # looks at the number of each tag
    assert pagewalk.walk(page.format("u > v"), form).title() == "u > v"
    # The same signs in one row, cut into other tags.
    form = form._replace(new_price=("a",))
    for first in ('<b x="><h3 class=spelled-in-this-test>1</h3>">', '<b x=><h3 class=spelled-in-this-test>1</h3>', '<b x=">"><h3>'):
        html = f'<div class="car-box">{first}2<h3 class="spelled-in-this-test">3</h3></div>'
        alone = pagewalk.Page(html, pagewalk.Tags(form)).title()
        assert pagewalk.walk(html, form).title() == alone == ("1" if "=><" in first else "3")


def test_pages_are_made_where_they_are_read(spark):
    from carledger.sources import derived

    made = derived.detail_pages(spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().toString()
    assert "lineitem.parquet" in plan and "-pages" not in plan
    assert not any(name == "pages" for _, _, name in derived._STORED)


def test_pages_cut_together_give_what_a_walk_over_each_gives():
    import random

    import pyarrow as pa

    from carledger.operators import pagewalk

    pick = random.Random(3)
    pieces = [
        "<ul>", "</ul>", "<ul class=basic-item-ul>", "<LI>", "</li>", "<li class='item-name'>", "<span class='item-name'>", "</span>",
        "<div class='all-basic-content'>", "<div class='car-box'>", "</div>", "<h3 class='car-brand-name' title='a > b'>", "</h3>",
        "<p class='brand-price-item'>", "<b class=price>", "<i class='price-nom'>", "</b>", "</i>", "<br>", "<a href='/x>y'>", "</a>",
        "<div class='bread-crumbs'><p class=content>", "燃油标号", " 92号 ", "所在地", "上牌&nbsp;时间：", "&#65509;1", "a > b", ">", " ", "",
    ]
    odd = ["<", "a < b", "<!-- <li> -->", "<script>'<li>'</script>", "<b title='<li>'>", "<b title='>", "<i\u3000x='1>2'>", "</b title=\"'>\">", "'", '"', "\0"]
    frames = [
        '<div class="all-basic-content"><ul class="basic-item-ul">{}</ul></div>',
        '<div class="car-box"><h3 class="car-brand-name">{}</h3><p class="brand-price-item"><b class="price">{}</b></p></div>',
        "{}",
    ]
    pages_ = ["", None, PAGE, ">", "<", PAGE + "> >", "x" * 50, PAGE.replace("<h3", "<h3 data-x='a > b'")]
    for _ in range(3000):
        some = [pick.choice(odd if pick.random() < 0.02 else pieces) for _ in range(pick.randrange(40))]
        pages_.append(pick.choice(frames).replace("{}", "".join(some)))
    form, parts = E.FORM._replace(card=""), ("title", "price", "new_price", "profile")
    cut = pa.array(["left out", *pages_])[1:]
    for all_blanks in (False, True):
        got = pagewalk.take(cut, form, parts, all_blanks)
        alone = [pagewalk.Page(html or "", pagewalk.Tags(form)) for html in pages_]
        assert got[:3] == [[getattr(p, part)() for p in alone] for part in parts[:3]]
        assert [[*p.items()] for p in got[3]] == [[*p.profile(all_blanks).items()] for p in alone]
    cuts = pagewalk._TAGS[form].cuts
    assert sum(plan is not None for plan in cuts.values()) > 1500  # most of them were cut together
    assert pagewalk.take(cut[:0], form, parts) == [[], [], [], []]


def test_most_pages_never_become_python_texts(monkeypatch):
    import pyarrow as pa

    from carledger.operators import pagewalk

    monkeypatch.setattr(pagewalk, "Page", None)
    monkeypatch.setattr(pagewalk, "_CUT", 1000)  # a few pages at once
    form = E.FORM._replace(card="", title=("car-box", "car-brand-name"), crumbs=("cut-in-this-test",))
    htmls = [PAGE.replace("A  2021", f"{k} > 1  2021").replace("<h3", "<h3 data-x='a > b'") for k in range(100)]
    title, profile = pagewalk.take(pa.array(htmls), form, ("title", "profile"))
    assert title == [f"{k} > 1  2021款 x1 plus" for k in range(100)]
    assert profile == [{"上牌时间": "2021年03月", "燃油标号": "92号"}] * 100


def test_pages_are_spelled_by_their_pieces(spark):
    """The same pages as if each whole page were written anew."""
    from carledger.sources import derived

    whole = derived._joined(derived._respelled(derived._page(lambda piece: piece)), derived._SIMILAR)
    pieces = derived._joined(derived._page(derived._respelled), derived._SIMILAR)
    keyed = derived.keyed_listings(spark, "/root/testdata/sf0.001")
    odd = keyed.withColumn("model", F.lit('x "1" <li>￥</li>&nbsp;</body></html> class="car-box"')).withColumn("level", F.lit(None).cast("string"))
    for rows in (keyed, odd.fillna("", ["level"]), odd):
        assert rows.filter(~whole.eqNullSafe(pieces)).isEmpty()
    made = derived.detail_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(replace(concat" not in made.replace("\n", "")
