"""Pages -> raw listings (E1-E9, S8). A page is walked once, in Arrow batches; what follows the walk stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.functions import text as X
from carledger.operators.pagewalk import Form, attribute_text, maps, take, walk
from carledger.schema import ELECTRIC, FUEL_GRADE_KEY, GASOLINE, RAW_COLUMNS, RAW_FIELDS

# Class names of the page form, outermost first.
CARD_CLASS = "cards-li"
TITLE_PATH = ["car-box", "car-brand-name"]
CRUMB_PATH = ["bread-crumbs", "content"]
PRICE_PATHS = [["car-box", "brand-price-item", "price"], ["cxc-priceCard", "left-module", "goodstartmoney"]]
NEW_PRICE_PATH = ["car-box", "brand-price-item", "price-nom"]
PROFILE_CLASS = "all-basic-content"
LIST_CLASS = "basic-item-ul"
NAME_CLASS = "item-name"

# Listing fields that come straight from the profile, by page key.
PROFILE_FIELDS = {
    key: name
    for key, name in RAW_FIELDS.items()
    if name not in ("brand", "style", "model", "current_price", "new_price", "fuel_type")
}

FORM = Form(
    title=tuple(TITLE_PATH),
    crumbs=tuple(CRUMB_PATH),
    prices=tuple(map(tuple, PRICE_PATHS)),
    new_price=tuple(NEW_PRICE_PATH),
    item_list=(PROFILE_CLASS, LIST_CLASS),
    item_name=NAME_CLASS,
    card=CARD_CLASS,
)

#: The cards alone: a walk looks for nothing else.
CARD_FORM = FORM._replace(title=(), crumbs=(), prices=(), new_price=(), item_list=("", ""), item_name="")

NO_TITLE, EMPTY_TITLE, NO_PRICE = "no title", "empty title", "no price"

_TEXT, _MAP = ("string", pa.string()), ("map<string, string>", pa.map_(pa.string(), pa.string()))
#: The parts of a page a listing is made of.
PARTS = {"title": _TEXT, "price": _TEXT, "new_price": _TEXT, "profile": _MAP}


def _form(parts: Sequence[str]) -> Form:
    """The page form with the paths of these parts alone: a walk looks for nothing else."""
    form = FORM._replace(card="")
    if "title" not in parts:
        form = form._replace(title=(), crumbs=())
    if "price" not in parts:
        form = form._replace(prices=())
    if "new_price" not in parts:
        form = form._replace(new_price=())
    return form if "profile" in parts else form._replace(item_list=("", ""), item_name="")


def _walked(html: Column, parts: Sequence[str], all_blanks: bool = False) -> Column:
    """These parts of a page as one struct, from one walk. Marked as not deterministic, so that the planner never walks a page
    twice for a filter and a result."""
    form = _form(parts)

    def run(pages: pa.Array) -> pa.Array:
        found = take(pages, form, tuple(parts), all_blanks)
        columns = [maps(v) if part == "profile" else pa.array(v, pa.string()) for part, v in zip(parts, found, strict=True)]
        return pa.StructArray.from_arrays(columns, names=list(parts))

    kinds = ", ".join(f"{part}: {PARTS[part][0]}" for part in parts)
    return F.arrow_udf(run, f"struct<{kinds}>").asNondeterministic()(html)


def _card_links(html: Column, form: Form = CARD_FORM) -> Column:
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([walk(page, form).links() for page in pages.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>").asNondeterministic()(html)


#: What holds no markup, and the link target of an anchor's start tag. Attributes are read one by one, so that neither a longer
#: name (data-href) nor a text inside a value is taken for one, and a quoted > doesn't end the tag.
_NO_MARKUP = r"(?is)<!--.*?-->|(<(script|style)(?=[\s/>])).*?(?=</\2|\z)"
_HREF = r"""(?is)<a(?:[\s/]++[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*?[\s/]++href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""


def _references(links_: Column) -> Column:
    """Character references in values of attributes, of any name. Only links are handed over, not pages."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array([[attribute_text(v) for v in vs] if vs else vs for vs in values.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(links_)


def anchors(html: Column) -> Column:
    """Link targets of a whole page in document order, repeats kept, empty ones left out. Values in quotes of either kind
    or in none, tags in any case; anchors in comments, scripts and styles are none."""
    hrefs = F.regexp_extract_all(F.regexp_replace(html, _NO_MARKUP, ""), F.lit(_HREF), F.lit(1))
    bare = F.transform(hrefs, lambda h: F.when(h.rlike("^[\"']"), h.substr(F.lit(2), F.length(h) - 2)).otherwise(h))
    return _references(F.filter(bare, lambda h: h != ""))


def links(pages: DataFrame, host: str = "", card_class: str | None = CARD_CLASS) -> DataFrame:
    """One row for each link inside a listing card (anywhere on the page without a card class), made absolute."""
    html = F.col("html")
    found = anchors(html) if card_class is None else _card_links(html, CARD_FORM._replace(card=card_class))
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.posexplode(found).alias("pos", "href")).select(
        *rest, "pos", F.concat(F.lit(host), F.col("href")).alias("link")
    )


def profile(html: Column, all_blanks: bool = False) -> Column:
    """The named list items of a page's profile section as a map; empty keys or values are left out, the last of equal
    keys wins. `all_blanks` removes every blank inside a key instead of plain and non-breaking spaces only."""
    return _walked(html, ["profile"], all_blanks)["profile"]


def profiles(pages: DataFrame, all_blanks: bool = False) -> DataFrame:
    """E2 for a frame: `html` replaced by `profile`."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, profile(F.col("html"), all_blanks).alias("profile"))


def profile_rows(pages: DataFrame, all_blanks: bool = False) -> DataFrame:
    """E2 as one row for each key: `html` replaced by `key, value`."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.explode(profile(F.col("html"), all_blanks)).alias("key", "value"))


def fuel_type(profile_map: Column) -> Column:
    """Gasoline if the page names a fuel grade, else electric."""
    grade = F.coalesce(F.try_element_at(profile_map, F.lit(FUEL_GRADE_KEY)), F.lit(""))
    return F.when(grade != "", GASOLINE).otherwise(ELECTRIC)


def profile_columns(profile_map: Column) -> dict[str, Column]:
    """The profile's listing fields, '' where missing."""
    return {
        name: F.coalesce(F.try_element_at(profile_map, F.lit(key)), F.lit("")) for key, name in PROFILE_FIELDS.items()
    }


def page_parts(pages: DataFrame, parts: Sequence[str] = tuple(PARTS)) -> DataFrame:
    """The parts of a page a listing is made of, or some of them: title (the first of two places), price (likewise), new price
    and profile; null where absent. Parts that aren't asked for are not taken from the page."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, _walked(F.col("html"), parts).alias("_p")).select(*rest, "_p.*")


def reject_reason() -> Column:
    """Why a page gives no listing; null for good pages. Over `page_parts`."""
    title = F.col("title")
    return (
        F.when(title.isNull(), NO_TITLE)
        .when(X.strip(title) == "", EMPTY_TITLE)
        .when(F.col("price").isNull(), NO_PRICE)
    )


def listings(parts: DataFrame) -> DataFrame:
    """Raw listings of the good pages, with the page's other columns in front."""
    title, profile_map = F.col("title"), F.col("profile")
    values = {
        "brand": X.title_brand(title),
        "style": X.title_style(title),
        "model": X.title_model(title),
        "current_price": X.price_text(F.col("price")),
        "new_price": X.new_price_text(F.col("new_price")),
        "fuel_type": fuel_type(profile_map),
        **profile_columns(profile_map),
    }
    rest = [c for c in parts.columns if c not in PARTS]
    good = parts.filter(reject_reason().isNull())
    return good.select(*rest, *[values[n].alias(n) for n in RAW_COLUMNS])


def rejects(parts: DataFrame) -> DataFrame:
    """The pages that give no listing, with the reason."""
    rest = [c for c in parts.columns if c not in PARTS]
    reasons = parts.withColumn("reason", reject_reason())
    return reasons.filter(F.col("reason").isNotNull()).select(*rest, "reason")


def frontier(provinces: DataFrame, max_pages: int = 100) -> DataFrame:
    """The list pages 1..max_pages of each province (`name`, `base_url`)."""
    return provinces.select(
        "name", "base_url", F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page")
    ).select("name", "page", F.concat("base_url", F.lit("&page="), F.col("page").cast("string")).alias("url"))
