"""Pages to rows (X1-X14). Payload tables are ``(page_id, url, payload VARIANT)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.functions import variants as V
from adledger.functions.text import as_col, is_valid_image_url, let
from adledger.operators.ordering import keep_rows

# fixed values: patterns and paths of the embedded documents
DATA_SCRIPT = r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*)'
SCRIPT_END = "</script>"
JSONLD_SCRIPT = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
PAGE_ANCHOR = r'<a\b[^>]*class="[^"]*pageLink[^"]*"[^>]*>'
PAGE_NUMBER = r'href="[^"]*?page=(\d+)'
PROPS = "$.props.pageProps"
CATEGORY_LISTS = ["verticalSubcats", "catChilds", "subcategories", "categories", "brands"]
DISTRICT_TYPE = "listings_district_filteration"
FULL_FILTER_TYPE = "listings_full_filtration"

CARD_FIELDS = {
    "id": "string", "title": "string", "slug": "string", "price": "string", "image": "string",
    "date_published": "string", "cat_id": "string", "phone": "string", "contact_no": "string",
    "district_name": "string", "status": "string", "images_count": "int",
}


FULL_CARD = {
    "id": "id", "title": "title", "title_ar": "title", "phone": "phone", "contact": "contact", "slug": "slug", "description_ar": "desc_ar",
    "description_en": "desc_en", "price": "price", "user_id": "user.user_id", "user_name": "user.name", "user_type": "user_type",
    "category_ar": "cat_ar_name", "category_en": "cat_en_name", "status": "status", "date_published": "date_published", "image_url": "image",
    "thumb_url": "thumb", "district_name_ar": "district_name_localize.ar", "district_name_en": "district_name_localize.en",
}


def embedded_payload(html: Column | str) -> Column:
    """X1 as an expression.

    The pattern only finds where the script starts; its end is a plain text search, which a long document
    takes far faster than a lazy match.
    """
    content = F.substring_index(F.regexp_extract(as_col(html), DATA_SCRIPT, 1), SCRIPT_END, 1)
    return V.parse(F.nullif(content, F.lit("")))


def page_payload(pages: DataFrame) -> DataFrame:
    """The embedded JSON document of each page; null when absent or invalid."""
    return pages.select("page_id", "url", embedded_payload("html").alias("payload"))


def jsonld_block(html: Column | str, target_type: str | None = None) -> Column:
    """X2 as an expression."""
    blocks = F.transform(F.regexp_extract_all(as_col(html), F.lit(JSONLD_SCRIPT), F.lit(1)), V.parse)

    def fits(block: Column) -> Column:
        return block.isNotNull() if target_type is None else V.text(block, "$['@type']") == target_type

    return F.try_element_at(F.filter(blocks, fits), F.lit(1))


def page_jsonld(pages: DataFrame, target_type: str | None = None) -> DataFrame:
    """The first valid JSON-LD block, of the target type when one is asked for."""
    return pages.select("page_id", "url", jsonld_block("html", target_type).alias("jsonld"))


def page_count_from_links(pages: DataFrame) -> DataFrame:
    """The largest page number of the pagination links, 1 without any."""
    tags = F.regexp_extract_all("html", F.lit(PAGE_ANCHOR), F.lit(0))
    numbers = F.transform(tags, lambda t: F.regexp_extract(t, PAGE_NUMBER, 1).try_cast("int"))
    return pages.select("page_id", F.coalesce(F.array_max(numbers), F.lit(1)).alias("total_pages"))


def page_total_pages(payloads: DataFrame) -> DataFrame:
    """The page count the payload tells; 1 when missing or zero."""
    told = V.whole("payload", f"{PROPS}.totalPages")
    return payloads.select("page_id", F.coalesce(F.nullif(told, F.lit(0).cast("bigint")), F.lit(1)).alias("total_pages"))


def commercial_total_pages(payloads: DataFrame, slug: Column) -> DataFrame:
    """X4 for commercials: the page count of the page's own category."""
    mine = F.filter(V.items("payload", f"{PROPS}.categories"), lambda c: V.text(c, "$.slug") == slug)
    told = V.whole(F.try_element_at(mine, F.lit(1)), "$.total_pages")
    return payloads.select("page_id", F.coalesce(told, F.lit(1)).alias("total_pages"))


def extract_categories(payloads: DataFrame, path: str) -> DataFrame:
    """Category nodes of one of the known lists; the commercial list drops its collecting entry."""
    if path not in CATEGORY_LISTS:
        raise ValueError(f"unknown category list: {path}")
    nodes = payloads.select("page_id", F.explode(V.items("payload", f"{PROPS}.{path}")).alias("n"))
    kind = V.text("n", "$.category_type")
    rows = nodes.select(
        "page_id",
        V.whole("n", "$.id").alias("category_id"),
        V.text("n", "$.slug").alias("slug"),
        F.coalesce(V.text("n", "$.name_ar"), V.text("n", "$.name")).alias("name_ar"),
        V.text("n", "$.name_en").alias("name_en"),
        V.whole("n", "$.listings_count").try_cast("int").alias("listings_count"),
        V.text("n", "$.slug_url").alias("slug_url"),
        kind.alias("category_type"),
        F.coalesce(kind == DISTRICT_TYPE, F.lit(False)).alias("has_districts"),
        V.text("n", "$.category_parent_slug").alias("parent_slug"),
    )
    return rows.filter(~F.coalesce(F.col("slug") == "all", F.lit(False))) if path == "categories" else rows


def district_slug(full_path_en: Column | str) -> Column:
    return F.concat(F.replace(F.lower(as_col(full_path_en)), F.lit(" "), F.lit("-")), F.lit("--district"))


def extract_districts(payloads: DataFrame) -> DataFrame:
    """Districts and the slug their listing pages use."""
    nodes = payloads.select("page_id", F.explode(V.items("payload", f"{PROPS}.districts")).alias("n"))
    fields = ["name_ar", "name_en", "full_path_ar", "full_path_en"]
    return nodes.select(
        "page_id", V.whole("n", "$.id").alias("id"), *[V.text("n", f"$.{f}").alias(f) for f in fields]
    ).withColumn("district_slug", district_slug("full_path_en"))


def extract_businesses(payloads: DataFrame, category_type: str) -> DataFrame:
    """Businesses of a category page."""
    nodes = payloads.select("page_id", F.explode(V.items("payload", f"{PROPS}.businessesData.data")).alias("n"))
    return nodes.select(
        "page_id", V.whole("n", "$.id").alias("id"),
        *[V.text("n", f"$.{f}").alias(f) for f in ("slug", "name", "logo")],
        F.lit(category_type).alias("category_type"),
    )


def extract_listing_cards(payloads: DataFrame, skip_ad_boxes: bool = True) -> DataFrame:
    """Listing cards of a page in order; rows that are ad boxes are left out."""
    cards = payloads.select("page_id", F.posexplode(V.items("payload", f"{PROPS}.listings")).alias("pos", "n"))
    if skip_ad_boxes:
        box = V.text("n", "$.adBoxId")
        cards = cards.filter(box.isNull() | box.isin("", "0", "false"))
    return cards.select(
        "page_id", "pos",
        *[V.get("n", f"$.{f}", kind).alias(f) for f, kind in CARD_FIELDS.items()],
        V.text("n", "$.user.user_id").alias("user_id"),
        V.text("n", "$.user.name").alias("user_name"),
    )


def extract_full_cards(payloads: DataFrame) -> DataFrame:
    """X8, longer form: cards with both descriptions, both district names, premium flag, views, reactions and all images."""
    cards = payloads.select("page_id", F.posexplode(V.items("payload", f"{PROPS}.listings")).alias("pos", "n"))
    return cards.select(
        "page_id", "pos", *[V.text("n", f"$.{path}").alias(name) for name, path in FULL_CARD.items()],
        V.get("n", "$.is_prem", "boolean").alias("is_premium"),
        V.whole("n", "$.views_count").alias("views_count"),
        F.coalesce(V.whole("n", "$.reactions.total_count"), F.lit(0).cast("bigint")).alias("reactions"),
        V.whole("n", "$.images_count").try_cast("int").alias("images_count"),
        F.coalesce(V.get("n", "$.thumbs", "array<string>"), F.array().cast("array<string>")).alias("all_images"),
    )


def extract_business_cards(payloads: DataFrame) -> DataFrame:
    """Listing cards of a business page."""
    path = f"{PROPS}.businessListings.data.listings.normal_items"
    cards = payloads.select("page_id", F.posexplode(V.items("payload", path)).alias("pos", "n"))
    names = {"cat_name_en": "cat_en_name", "cat_name_ar": "cat_ar_name"}
    fields = [
        "id", "title", "slug", "price", "image", "date_published", "cat_id", "cat_name_en", "cat_name_ar", "phone",
        "contact", "status", "description", "user_type",
    ]
    return cards.select(
        "page_id", "pos", *[V.text("n", f"$.{names.get(f, f)}").alias(f) for f in fields],
        V.whole("n", "$.images_count").try_cast("int").alias("images_count"),
    )


def _commercial(doc: Column | str) -> list[Column]:
    texts = ["title", "image", "phone", "whatsapp_phone", "target_url", "open_target_url"]
    return [
        V.whole(doc, "$.id").alias("id"),
        *[V.text(doc, f"$.{f}").alias(f) for f in texts],
        V.whole(doc, "$.category.id").alias("category_id"),
        V.text(doc, "$.category.slug").alias("category_slug"),
        V.get(doc, "$.is_landing", "boolean").alias("is_landing"),
        V.whole(doc, "$.views_count").alias("views_count"),
    ]


def extract_commercial_ads(payloads: DataFrame) -> DataFrame:
    """Commercial ads of a category page."""
    ads = payloads.select("page_id", F.explode(V.items("payload", f"{PROPS}.commercialAds")).alias("n"))
    return ads.select("page_id", *_commercial("n"))


def extract_commercial_details(payloads: DataFrame) -> DataFrame:
    """The ad record of a detail page, with the page's address."""
    details = payloads.select("page_id", "url", V.get("payload", f"{PROPS}.adDetails", "variant").alias("n"))
    return keep_rows(details, V.is_object("n")).select("page_id", *_commercial("n"), "url")


def extract_brand_types(payloads: DataFrame) -> DataFrame:
    """X11: brands and their types with counts; a brand without types keeps one row."""
    brands = payloads.select("page_id", F.explode(V.items("payload", f"{PROPS}.brands")).alias("b"))
    pairs = brands.select("page_id", "b", F.explode_outer(V.items("b", "$.types")).alias("t"))
    return pairs.select(
        "page_id",
        V.text("b", "$.name_en").alias("brand"),
        V.text("b", "$.name_ar").alias("brand_ar"),
        V.text("b", "$.slug_url").alias("brand_slug"),
        V.whole("b", "$.listings_count").alias("brand_count"),
        V.text("t", "$.name_en").alias("type"),
        V.text("t", "$.name_ar").alias("type_ar"),
        V.text("t", "$.slug_url").alias("type_slug"),
        F.when(F.col("t").isNotNull(), F.coalesce(V.whole("t", "$.listings_count"), F.lit(0).cast("bigint"))).alias("type_count"),
    )


DIRECTORY_ROW = "array<struct<position:bigint,name:string,url:string,slug:string,price_range:string,image:string>>"


def extract_directory_list(pages: DataFrame, category_slug: Column, base_url: str) -> DataFrame:
    """Businesses of a directory page, from its payload when it lists any, else from its JSON-LD."""
    parsed = pages.select(
        "page_id", category_slug.alias("category_slug"),
        embedded_payload("html").alias("p"), jsonld_block("html", "CollectionPage").alias("j"),
    )

    def some(path: str) -> Column:
        found = V.items("p", path)
        return F.when(F.size(found) > 0, found)

    def from_payload(b: Column, i: Column) -> Column:
        slug = F.coalesce(V.text(b, "$.slug"), F.lit(""))
        return F.struct(
            (i + 1).cast("bigint").alias("position"),
            F.coalesce(V.text(b, "$.name"), F.lit("")).alias("name"),
            F.concat(F.lit(f"{base_url}/"), F.col("category_slug"), F.lit("/"), slug).alias("url"),
            slug.alias("slug"),
            F.coalesce(V.text(b, "$.priceRange"), V.text(b, "$.price_range"), F.lit("")).alias("price_range"),
            F.coalesce(V.text(b, "$.logo"), V.text(b, "$.image"), F.lit("")).alias("image"),
        )

    def from_jsonld(e: Column) -> Column:
        url = F.coalesce(V.text(e, "$.item.url"), F.lit(""))
        image = F.coalesce(V.text(e, "$.item.image.url"), F.when(V.is_text(e, "$.item.image"), V.text(e, "$.item.image")), F.lit(""))
        return F.struct(
            V.whole(e, "$.position").alias("position"),
            F.coalesce(V.text(e, "$.item.name"), F.lit("")).alias("name"),
            url.alias("url"),
            F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1).alias("slug"),
            F.coalesce(V.text(e, "$.item.priceRange"), F.lit("")).alias("price_range"),
            image.alias("image"),
        )

    own = F.coalesce(some(f"{PROPS}.businesses"), some(f"{PROPS}.items"), some(f"{PROPS}.listings"))
    told = F.filter(V.items("j", "$.mainEntity.itemListElement"), lambda e: F.size(V.members(e, "$.item")) > 0)
    rows = F.coalesce(F.transform(own, from_payload), F.transform(told, from_jsonld)).cast(DIRECTORY_ROW)
    source = F.when(own.isNotNull(), "payload").otherwise("jsonld")
    return parsed.select("page_id", "category_slug", source.alias("source"), F.inline(rows))


def extract_business_profile(payloads: DataFrame, category_slug: Column) -> DataFrame:
    """The profile record of a business page, blanks and zeros where the page tells nothing.

    Nested hours, branches, reviews, tabs and media stay arrays for the listing operators.
    """
    found = payloads.select(
        "page_id", category_slug.alias("category_slug"),
        V.get("payload", f"{PROPS}.business", "variant").alias("b"), V.get("payload", f"{PROPS}.tabs", "variant").alias("t"),
    )
    parsed = keep_rows(found, F.size(V.members("b", "$")) > 0)

    def text(path: str) -> Column:
        return F.coalesce(V.text("b", path), F.lit(""))

    def flag(path: str) -> Column:
        return F.coalesce(V.get("b", path, "boolean"), F.lit(False))

    plain = ["name", "slug", "about", "status", "display_title", "display_description", "created_at", "updated_at"]
    flags = {
        "delivery": "delivery", "takeaway": "takeaway", "dine_in": "dine_in", "parking": "parking", "wifi": "wi_fi",
        "wheelchair_accessible": "wheelchair_accessible_entrance",
    }
    social = F.filter(F.transform(V.items("b", "$.social_media"), lambda s: V.text(s, "$.url")), lambda u: F.coalesce(u != "", F.lit(False)))
    numbers = V.get("b", "$.contact_info.contact_numbers", "array<string>")
    hours = "array<struct<day_name:string,open_time:string,close_time:string>>"
    branches = "array<struct<name:string,address:string,phone:string,latitude:double,longitude:double,is_main:boolean>>"
    reviews = "array<struct<rating:double,comment:string,user_name:string,created_at:string>>"
    return parsed.select(
        "page_id",
        V.whole("b", "$.id").alias("id"),
        "category_slug",
        *[text(f"$.{f}").alias(f) for f in plain],
        text("$.category.name").alias("category_name"),
        *[let(text(f"$.{f}"), lambda u: F.when(is_valid_image_url(u), u).otherwise("")).alias(f) for f in ("logo", "cover_image")],
        F.coalesce(V.real("b", "$.rating.average"), F.lit(0.0)).alias("rating_average"),
        F.coalesce(V.whole("b", "$.rating.count"), F.lit(0).cast("bigint")).alias("rating_count"),
        F.coalesce(V.whole("b", "$.view_count"), F.lit(0).cast("bigint")).alias("view_count"),
        F.coalesce(F.array_join(numbers, ", "), F.lit("")).alias("contact_numbers"),
        text("$.contact_info.website").alias("website"),
        F.coalesce(F.array_join(social, ", "), F.lit("")).alias("social_media"),
        *[flag(f"$.attributes.{path}").alias(name) for name, path in flags.items()],
        V.get("b", "$.working_hours", hours).alias("hours"),
        V.get("t", "$.about.data.branches", branches).alias("branches"),
        V.get("t", "$.reviews.data.reviews", reviews).alias("reviews"),
        F.coalesce(V.whole("t", "$.reviews.summary.total_reviews"), F.lit(0).cast("bigint")).alias("reviews_count"),
        F.coalesce(V.real("t", "$.reviews.summary.average_rating"), F.lit(0.0)).alias("reviews_average"),
        V.get("b", "$.tabs", "array<struct<slug:string,enabled:boolean>>").alias("tabs"),
        V.get("t", "$.media.data.media", "array<struct<url:string,media_category:string>>").alias("media"),
    )


def classify_category_shape(payloads: DataFrame, rule: str = "children", category_type: Column | None = None) -> DataFrame:
    """How a category page is built.

    ``children``: child categories, then sub-categories, else direct. ``property``: sub-categories, then
    businesses, else direct. ``districts``: child categories, then district pages by type, else direct.
    """
    has = lambda path: F.coalesce(F.size(V.items("payload", f"{PROPS}.{path}")) > 0, F.lit(False))
    if rule == "children":
        shape = F.when(has("catChilds"), "catchilds").when(has("subcategories"), "subcategories")
    elif rule == "property":
        shape = F.when(has("subcategories"), "subcategories").when(has("businessesData.data"), "businesses")
    elif rule == "districts":
        kind = category_type if category_type is not None else V.text("payload", f"{PROPS}.category.category_type")
        shape = F.when(has("catChilds"), "catchilds").when(kind.isin(DISTRICT_TYPE, FULL_FILTER_TYPE), "districts")
    else:
        raise ValueError(f"unknown shape rule: {rule}")
    return payloads.select("page_id", shape.otherwise("direct").alias("shape"))
