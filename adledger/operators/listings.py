"""Listing shaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger import rules
from adledger.functions import variants as V
from adledger.functions.moments import relative_age
from adledger.functions.text import as_col, file_name, is_valid_image_url, let, no_texts
from adledger.operators.ordering import keep_rows
from adledger.operators.pages import PROPS


def filter_listing_day(cards: DataFrame, day: str, keep_null: bool = False) -> DataFrame:
    """Rows published on the day; rows without a date only when ``keep_null``."""
    on_day = F.col("date_published").startswith(day)
    return cards.filter(F.coalesce(on_day, F.lit(keep_null)))


def cut_pages_first_empty(cards: DataFrame, day: str, max_pages: int, keys: list[str]) -> DataFrame:
    """Rows of the day up to the first page that has none, at most ``max_pages``.

    The end of the first unbroken run of pages is the smallest page whose next page is absent; page 0 stands
    in for "no page at all". One anti join over distinct pages, no ordered pass over a category.
    """
    rows = filter_listing_day(cards, day).filter(F.col("page") <= max_pages)
    pages = rows.select(*keys, "page").distinct()
    starts = pages.select(*keys, F.lit(0).alias("page")).distinct()
    previous = pages.select(*keys, (F.col("page") - 1).alias("page"))
    ends = pages.unionByName(starts).join(previous, [*keys, "page"], "left_anti")
    last = ends.groupBy(*keys).agg(F.min("page").alias("_last"))
    return rows.join(last, keys).filter(F.col("page") <= F.col("_last")).drop("_last")


def cut_pages_by_total(cards: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """P2 variant: pages up to the page count the category tells."""
    return cards.join(totals, keys).filter(F.col("page") <= F.col("total_pages")).drop("total_pages")


def cut_pages_found_older(cards: DataFrame, day: str, keys: list[str]) -> DataFrame:
    """Rows of the day up to and including the first page that shows an older row."""
    older = F.when(F.substring("date_published", 1, 10) < day, F.col("page"))
    stops = cards.groupBy(*keys).agg(F.min(older).alias("_stop"))
    rows = filter_listing_day(cards, day)
    return rows.join(stops, keys).filter(F.col("_stop").isNull() | (F.col("page") <= F.col("_stop"))).drop("_stop")


def project_listing_detail(payloads: DataFrame, now: Column) -> DataFrame:
    """The flat detail record of a listing page; pages without a listing drop out.

    Attributes stay an array; :func:`attributes_to_maps` turns them into maps.
    """
    texts = lambda *names: ", ".join(f"{n}: string" for n in names)
    attribute_kind = f"struct<attrData: struct<{texts('name_en', 'name_ar', 'type')}>, valData: variant>"
    kind = (
        f"struct<{texts('user_adv_id', 'slug', 'title', 'description', 'price', 'phone', *LISTING_DATES, 'lon', 'lat')}, "
        f"images: array<string>, user_view_count: variant, is_private_message_enabled: boolean, is_hide_my_number: boolean, "
        f"district: struct<{texts('name', 'full_path', 'full_path_en')}>, "
        f"user: struct<{texts('first_name', 'email', 'listings_count', 'image', 'user_type', 'member_since')}, is_verified: boolean>, "
        f"attrsAndVals: array<variant>>"
    )
    found = payloads.select("page_id", V.get("payload", f"{PROPS}.listing", "variant").alias("l")).withColumn("d", V.get("l", "$", kind))
    doc = keep_rows(found, F.size(V.members("l", "$")) > 0).withColumn("i", F.coalesce("d.images", no_texts()))
    d = F.col("d")

    def attribute(a: Column) -> Column:
        def told(f: Column, nested: Column) -> Column:
            is_text = V.get(f["valData"], "$", "array<variant>").isNull() & (F.schema_of_variant(f["valData"]) == "STRING")
            val_kind = F.when(nested.isNotNull(), "object").when(is_text, "string").otherwise("other")
            return F.struct(
                *[f["attrData"][c].alias(c) for c in ("name_en", "name_ar", "type")], val_kind.alias("val_kind"),
                F.when(val_kind == "string", V.text(f["valData"], "$")).alias("val"),
                nested["name_en"].alias("val_en"), nested["name_ar"].alias("val_ar"),
            )

        value = lambda f: V.get(f["valData"], "$", "struct<name_en: string, name_ar: string>")
        return let(V.get(a, "$", attribute_kind), lambda f: let(value(f), lambda nested: told(f, nested)))

    return doc.select(
        "page_id",
        d["user_adv_id"].alias("id"), *[d[c].alias(c) for c in ("slug", "title", "description", "price", "phone", "date_published")],
        relative_age(d["date_published"], now).alias("date_relative"),
        *[d[c].alias(c) for c in LISTING_DATES[1:]],
        F.col("i").alias("images"), F.size("i").alias("images_count"),
        d["district"]["name"].alias("address"), d["district"]["full_path"].alias("full_address"),
        d["district"]["full_path_en"].alias("full_address_en"),
        V.told_whole(d["user_view_count"]).alias("views_no"),
        d["lon"].try_cast("double").alias("longitude"), d["lat"].try_cast("double").alias("latitude"),
        d["user"]["first_name"].alias("user_name"), d["user"]["email"].alias("user_email"),
        F.concat(F.coalesce(d["user"]["listings_count"], F.lit("None")), F.lit(" ads")).alias("user_ads"),
        d["user"]["image"].alias("user_image"), d["user"]["user_type"].alias("user_type"),
        F.element_at(F.split(F.coalesce(d["user"]["member_since"], F.lit("")), "T"), 1).alias("membership"),
        d["user"]["is_verified"].alias("is_verified"),
        d["is_private_message_enabled"].alias("is_private_message_enabled"),
        d["is_hide_my_number"].alias("is_hide_my_number"),
        F.transform(d["attrsAndVals"], attribute).alias("attrs"),
    )


LISTING_DATES = ["date_published", "date_created", "date_expired", "date_sort"]
SHORT_DETAIL = [
    "id", "date_published", "date_relative", "date_sort", "date_expired", "title", "description", "link", "images", "price", "address",
    "full_address", "views_no", "longitude", "latitude", "user_name", "user_email", "user_ads", "user_image", "user_type", "membership",
    "is_verified", "phone", "status",
]


def short_listing_detail(details: DataFrame, cards: DataFrame, base: str) -> DataFrame:
    """P4, short form: fewer fields, the listing's address as ``link``, and the status its card told."""
    with_link = details.withColumn("link", F.concat(F.lit(base.rstrip("/") + "/"), F.col("slug")))
    return join_cards_details(cards, with_link, ["status"]).select("page_id", *SHORT_DETAIL)


def join_cards_details(cards: DataFrame, details: DataFrame, carry: list[str], pin_default: str | None = None) -> DataFrame:
    """P5: details of each card by slug; cards without slug or detail drop out; ``carry`` columns come from the card."""
    side = cards.filter(F.coalesce("slug", F.lit("")) != "").select("slug", *carry)
    if pin_default is not None and "pin" in carry:
        side = side.withColumn("pin", F.coalesce(F.nullif("pin", F.lit("")), F.lit(pin_default)))
    return details.drop(*carry).join(side, "slug")


def join_business_profiles(listed: DataFrame, profiles: DataFrame, key: str = "url") -> DataFrame:
    """Profile fields override list fields; a business without profile keeps its list row; no address, no row."""
    left = listed.filter(F.coalesce(key, F.lit("")) != "")
    own = [c for c in profiles.columns if c != key]
    right = profiles.withColumn("_has", F.lit(True)).select(key, "_has", *[F.col(c).alias(f"_p_{c}") for c in own])
    joined = left.join(right, key, "left")
    merged = [
        F.when(F.col("_has"), F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in left.columns
    ]
    return joined.select(*merged, *[F.col(f"_p_{c}").alias(c) for c in own if c not in left.columns])


def union_category_pages(frames: dict[str, DataFrame]) -> DataFrame:
    """Record sets put together under the name of their child category; nothing is made distinct."""
    labelled = [df.withColumn("child", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def skip_empty_categories(listings: DataFrame, categories: DataFrame, key: str = "slug") -> DataFrame:
    """Listings of categories that have any."""
    filled = categories.filter(F.coalesce("listings_count", F.lit(0)) != 0)
    return listings.join(filled.select(F.col(key).alias("category")), "category", "left_semi")


def normalize_service_listing(listings: DataFrame, doc: str = "listing") -> DataFrame:
    """The 22 columns of a service listing, each from the first place that tells."""
    t = lambda path: V.text(doc, f"$.{path}")
    filled = lambda *paths: F.coalesce(*[F.nullif(t(p), F.lit("")) for p in paths])
    or_blank = lambda c: F.coalesce(c, F.lit(""))
    joined = lambda path: or_blank(F.array_join(V.get(doc, f"$.{path}", "array<string>"), ","))
    has_user = F.size(V.members(doc, "$.user")) > 0
    images = V.get(doc, "$.images", "array<string>")
    district = F.when(F.size(V.members(doc, "$.district")) > 0, t("district.name")).otherwise(t("district_name_localize.en"))
    return listings.select(
        filled("id", "user_adv_id").alias("ID"),
        t("title").alias("Title"),
        filled("phone", "contact").alias("Phone"),
        or_blank(F.when(has_user, filled("user.name", "user.first_name"))).alias("User"),
        or_blank(F.when(has_user, filled("user.user_id", "user.id"))).alias("User ID"),
        or_blank(F.when(has_user, t("user.email"))).alias("User Email"),
        filled("description", "desc_en").alias("Description"),
        t("price").alias("Price"),
        t("date_published").alias("Date Published"),
        t("date_created").alias("Date Created"),
        t("date_expired").alias("Date Expired"),
        t("date_sort").alias("Date Sort"),
        F.coalesce(F.size(images), F.lit(0)).alias("Images Count"),
        joined("images").alias("Image URLs"),
        or_blank(district).alias("District"),
        or_blank(t("category.name")).alias("Category"),
        joined("contacts").alias("Contacts"),
        F.coalesce(V.get(doc, "$.is_private_message_enabled", "boolean"), F.lit(False)).alias("PM Enabled"),
        or_blank(t("lat")).alias("Latitude"),
        or_blank(t("lon")).alias("Longitude"),
        or_blank(t("slug")).alias("Slug"),
        or_blank(t("status")).alias("Status"),
    )


def rename_for_export(listings: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """P10: columns under their export headers; lists become text, absent columns null (blank for three texts)."""
    headers = mapping or rules.EXPORT_HEADERS
    kinds = dict(listings.dtypes)
    blank = {"description", "specification_en", "specification_ar"}

    def column(source: str, header: str) -> Column:
        if source not in kinds:
            return F.lit("" if source in blank else None).cast("string").alias(header)
        if kinds[source].startswith("array"):
            return F.coalesce(F.array_join(source, " | "), F.lit("")).alias(header)
        return F.col(source).alias(header)

    return listings.select(*[column(s, h) for s, h in headers.items()])


PAIRS = "array<struct<key:string,value:string>>"


def last_wins_map(entries: Column) -> Column:
    """Entries as a map: keys in first-seen order, each with its last value. Needs no session setting."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    newest = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), newest(k).alias("value"))))


def attributes_to_maps(df: DataFrame, rule: str = "standard") -> DataFrame:
    """The attribute list as English, Arabic and combined maps.

    ``standard`` drops empty values, ``property`` keeps them, ``new`` keeps them and has no number rule.
    """
    if rule not in ("standard", "property", "new"):
        raise ValueError(f"unknown attribute rule: {rule}")

    def value(a: Column, text: str, yes: str, no: str) -> Column:
        flag = F.when(a["val"] == "1", yes).otherwise(no)
        number = F.lit(False) if rule == "new" else F.coalesce(a["type"] == "number", F.lit(False))
        return F.when(a["val_kind"] == "object", a[text]).otherwise(F.when(number, a["val"]).otherwise(flag))

    def pair(a: Column, name: str, value_: Column) -> Column:
        keep = F.coalesce(a[name] != "", F.lit(False))
        if rule == "standard":
            keep = keep & F.coalesce(value_ != "", F.lit(False))
        return F.when(keep, F.struct(a[name].alias("key"), value_.alias("value")))

    english = lambda a: pair(a, "name_en", value(a, "val_en", "Yes", "No"))
    arabic = lambda a: pair(a, "name_ar", value(a, "val_ar", "نعم", "لا"))
    present = lambda pairs: F.coalesce(F.filter(pairs, lambda p: p.isNotNull()), F.array().cast(PAIRS))
    told = F.filter("attrs", lambda a: a["val_kind"].isin("object", "string"))
    both = F.flatten(F.transform(told, lambda a: F.array(english(a), arabic(a))))
    return df.select(
        *[c for c in df.columns if c != "attrs"],
        last_wins_map(present(F.transform(told, english))).alias("spec_en"),
        last_wins_map(present(F.transform(told, arabic))).alias("spec_ar"),
        last_wins_map(present(both)).alias("attributes"),
    )


def widen_attributes(df: DataFrame, keys: list[str]) -> DataFrame:
    """One column per attribute name, read from the map of each row; no shuffle."""
    return df.select(
        *[c for c in df.columns if c != "attributes"], *[F.try_element_at("attributes", F.lit(k)).alias(k) for k in keys]
    )


def image_key(base: Column, save_date: Column, category: Column, record: Column, url: Column, index: Column, parent: Column | None = None) -> Column:
    """The key of an image; with ``parent`` its category's folder stands below that of the parent category."""
    above = F.lit("") if parent is None else F.coalesce(F.concat(F.nullif(parent, F.lit("")), F.lit("/")), F.lit(""))
    name = F.when(record.isNotNull(), F.concat(record.cast("string"), F.lit("_"), index.cast("string"), F.lit(".jpg")))
    folder = F.date_format(save_date, "'/year='yyyy'/month='MM'/day='dd'/images/'")
    return F.concat(base, folder, above, category, F.lit("/"), F.coalesce(name, file_name(url)))


def assign_image_keys(df: DataFrame, base: str, limit: int | None = None, parent: str | None = None) -> DataFrame:
    """A row per image with the key it is stored under; only the first ``limit`` images when given.

    ``parent`` names the column of the parent category, where keys go below its folder.
    """
    images = F.slice("images", 1, limit) if limit else F.col("images")
    rows = df.select("id", "category", "save_date", *([parent] if parent else []), F.posexplode(images).alias("image_index", "url"))
    above = F.col(parent) if parent else None
    key = image_key(F.lit(base), F.col("save_date"), F.col("category"), F.col("id"), F.col("url"), F.col("image_index"), above)
    return rows.withColumn("image_key", key)


def collect_image_keys(images: DataFrame, url_prefix: str = "") -> DataFrame:
    """The image keys of each record in image order, as a list, one text and JSON."""
    keys = F.transform(
        F.array_sort(F.collect_list(F.struct("image_index", "image_key"))),
        lambda i: F.concat(F.lit(url_prefix), i["image_key"]),
    )
    return images.groupBy("id").agg(keys.alias("image_keys")).select(
        "id", "image_keys", F.array_join("image_keys", " | ").alias("images_text"), F.to_json("image_keys").alias("images_json")
    )


def filter_image_urls(df: DataFrame, column: str = "url") -> DataFrame:
    """P16."""
    return df.filter(is_valid_image_url(column))


def business_image_roster(profiles: DataFrame) -> DataFrame:
    """Logo, cover and media images of each business with their file names.

    The number in a name is a stable hash of the address, so a rerun gives the same names.
    """
    entry = lambda kind, url: F.struct(kind.alias("kind"), url.alias("url"))
    media = F.transform("media_urls", lambda u, i: entry(F.concat(F.lit("media_"), i.cast("string")), u))
    logo, cover = F.nullif("logo", F.lit("")), F.nullif("cover_image", F.lit(""))
    own = F.filter(
        F.array(
            F.when(logo.isNotNull(), entry(F.lit("logo"), logo)),
            F.when(cover != "media", entry(F.lit("cover"), cover)),
        ),
        lambda e: e.isNotNull(),
    )
    rows = profiles.select("id", F.inline(F.concat(own, F.coalesce(media, F.array().cast("array<struct<kind:string,url:string>>")))))
    path = F.regexp_replace("url", r"^[a-zA-Z]+://[^/?#]*|[?#].*$", "")
    ext = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    safe = F.when((ext == "") | (F.length(ext) > 5), ".jpg").otherwise(ext)
    number = F.pmod(F.xxhash64("url"), F.lit(10000)).cast("string")
    name = F.concat(F.lit("business_"), F.col("id").cast("string"), F.lit("_image_"), number, safe)
    return rows.withColumn("file_name", name)


def split_media(profiles: DataFrame) -> DataFrame:
    """Media addresses as all, gallery and menu texts, only where the media tab is on."""
    enabled = F.coalesce(F.exists("tabs", lambda t: (t["slug"] == "media") & t["enabled"]), F.lit(False))
    usable = F.when(enabled, F.filter("media", lambda m: is_valid_image_url(m["url"])))
    texts = lambda kept: F.coalesce(F.array_join(F.transform(kept, lambda m: m["url"]), " | "), F.lit(""))
    of_kind = lambda kind: F.filter(usable, lambda m: m["media_category"] == kind)
    return profiles.select(
        "id", F.when(usable.isNull(), 0).otherwise(F.size(usable)).alias("media_count"), texts(usable).alias("media_urls"),
        texts(of_kind("gallery")).alias("gallery_urls"), texts(of_kind("menu")).alias("menu_urls"),
    )


def pick_main_branch(profiles: DataFrame) -> DataFrame:
    """The main branch, else the first, else blanks; with count and JSON of all."""
    mains = F.filter("branches", lambda b: F.coalesce(b["is_main"], F.lit(False)))
    main = F.coalesce(F.try_element_at(mains, F.lit(1)), F.try_element_at("branches", F.lit(1)))
    return profiles.withColumn("_m", main).select(
        "id",
        F.coalesce("_m.address", F.lit("")).alias("main_branch_address"),
        F.coalesce("_m.phone", F.lit("")).alias("main_branch_phone"),
        F.col("_m.latitude").alias("main_branch_latitude"),
        F.col("_m.longitude").alias("main_branch_longitude"),
        F.when(F.col("branches").isNull(), 0).otherwise(F.size("branches")).alias("branches_count"),
        F.coalesce(F.to_json("branches"), F.lit("[]")).alias("branches_json"),
    )


def recent_reviews(profiles: DataFrame, k: int = 5) -> DataFrame:
    """The first reviews as JSON, with count and average from the summary."""
    return profiles.select(
        "id", "reviews_count", "reviews_average", F.coalesce(F.to_json(F.slice("reviews", 1, k)), F.lit("[]")).alias("recent_reviews_json")
    )


def format_working_hours(hours: Column | str) -> Column:
    """P20: one text of days and times; days that lack a part are left out."""
    part = lambda h, f: F.coalesce(h[f], F.lit(""))
    whole = F.filter(as_col(hours), lambda h: (part(h, "day_name") != "") & (part(h, "open_time") != "") & (part(h, "close_time") != ""))
    line = lambda h: F.concat(h["day_name"], F.lit(": "), h["open_time"], F.lit("-"), h["close_time"])
    return F.coalesce(F.array_join(F.transform(whole, line), " | "), F.lit(""))


def reorder_columns(df: DataFrame, wanted: list[str], keep_rest: bool) -> DataFrame:
    """Wanted columns that exist, in that order, then the rest when kept."""
    first = [c for c in wanted if c in df.columns]
    rest = [c for c in df.columns if c not in wanted] if keep_rest else []
    return df.select(*first, *rest)
