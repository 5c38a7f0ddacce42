"""Fixed values of the data contract: word lists, lookup tables, limits."""

# --- fixed values: sheets -------------------------------------------------------------------------
SKIP_SHEETS = ["info", "no data"]
GENERIC_SHEETS = ["sheet1", "main", "data", "listings", "all listings"]
TEMPLATE_MARKERS = ["{", "or Main", "or All Listings"]
SHEET_NAME_LIMIT = 31
CHECK_LABEL_LIMIT = 20
TREND_LABEL_LIMIT = 18

# --- fixed values: column roles, raw spellings and canonical spellings ------------------------------
ID_COLUMNS = ["id", "listing id", "listing_id", "user_adv_id", "user adv id", "ad_id", "ad id"]
ID_CANONICAL = ["id", "listingid", "useradvid", "adid"]
PHONE_COLUMNS = [
    "phone", "phone number", "phonenumber", "user_phone", "user phone", "whatsapp_phone",
    "whatsapp phone", "contacts", "contact_no", "contact no", "main_branch_phone", "main branch phone",
]
PHONE_CANONICAL = [
    "phone", "phonenumber", "userphone", "whatsappphone", "contacts", "contactno", "mainbranchphone",
]
HIDE_COLUMNS = ["is_hide_my_number", "is hide my number", "hide_my_number", "hide my number"]
DATE_COLUMNS = ["date_published", "date published"]
QUALITY_ID_COLUMNS = ["id", "listing id"]

# --- fixed values: canonical header aliases ---------------------------------------------------------
HEADER_ALIASES = {
    "listingid": "id",
    "savedtos3date": "saveddate",
    "savedtor2date": "saveddate",
    "datascrapeddate": "scrapeddate",
    "s3images": "images",
    "r2images": "images",
    "s3imagespaths": "imagespaths",
    "r2imagespaths": "imagespaths",
    "displaytitle": "name",
    "displaydescription": "about",
    "relativedate": "daterelative",
    "viewsno": "views",
    "fulladdressen": "fulladdress",
    "descriptionen": "description",
    "descriptionar": "description",
    "phonenumber": "phone",
    "whatsappphone": "phone",
}
OPTIONAL_HEADERS = [
    "images", "imagespaths", "s3images", "r2images", "r2imagespaths", "imagescount", "imageurls", "pin",
    "specificationen", "specificationar", "slug", "daterelative", "datecreated", "dateexpired",
    "saveddate", "scrapeddate", "categoryarabic", "categoryenglish", "hassubcategories",
    "subcategoriescount", "userphone", "useremail", "fulladdressen", "fulladdress", "membership",
    "isverified", "description", "views", "latitude", "longitude",
]

# --- fixed values: phones and ids -------------------------------------------------------------------
NULL_WORDS = ["nan", "none", "null"]
TRUE_WORDS = ["1", "true", "yes", "y", "t"]
COUNTRY_CODE = "965"
LOCAL_PHONE_LENGTH = 8
LOCAL_PHONE_PREFIXES = ["2", "4", "5", "6", "9"]
MAX_PHONE_LENGTH = 13
MIN_AD_ID_LENGTH = 3
INVALID_PCT_LIMIT = 15.0
SAMPLE_LIMIT = 25
SAMPLE_WIDTH = 80

# --- fixed values: storage types by file extension --------------------------------------------------
STORAGE_TYPES = {
    "images": [".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp", ".tiff", ".svg"],
    "json": [".json"],
    "excel": [".xlsx", ".xls", ".xlsm"],
    "csv": [".csv"],
    "parquet": [".parquet"],
}
STORAGE_CATEGORIES = ["images", "json", "excel", "csv", "parquet", "other"]

# --- fixed values: keys of summary documents, in order of preference --------------------------------
TOTAL_KEYS = ["total_listings", "total_ads", "listings_count"]
TOTAL_LISTS = ["subcategories", "main_categories", "categories", "excel_files", "items"]
BREAKDOWN_LISTS = ["categories", "main_categories", "subcategories", "items"]
BREAKDOWN_CHILDREN = ["subcategories", "brands", "models"]
BREAKDOWN_COUNT_KEYS = [
    "ads_count", "listings_count", "total_listings", "total_ads", "listings", "total_businesses", "count",
]
CATEGORY_NAME_KEYS = ["name_en", "name", "name_ar", "category", "category_name", "slug"]
CHILD_NAME_KEYS = ["name_en", "name", "name_ar", "model", "brand", "slug"]
REQUEST_TOTAL_KEYS = [
    "requests_total", "total_http_requests", "http_requests", "scrape_do_requests", "request_count",
]
REQUEST_FAILED_KEYS = [
    "requests_failed", "failed_requests", "requests_errors", "errors_count", "http_errors",
]
DURATION_KEYS = ["duration_sec", "elapsed_seconds", "scrape_duration_sec", "runtime_sec"]
RPM_KEYS = ["requests_per_min", "req_per_min", "avg_requests_per_min", "rpm"]
CACHE_KEYS = ["cache_hits", "cache_hits_free"]
HOUR_LIST_KEYS = ["ads_by_hour", "hourly_ads"]
HOUR_MAP_KEYS = ["date_published_hour_counts", "hourly_counts", "hour_counts", "date_published_hours"]
HOUR_CONTAINERS = ["stats", "ads_stats", "summary"]

# --- fixed values: schedules and workflows ----------------------------------------------------------
NON_DAILY_SCHEDULES = ["monthly", "quarterly", "every_2_days", "weekly", "biweekly"]
REPORT_LOOKBACK_DAYS = {"monthly": 31, "quarterly": 120, "every_2_days": 7, "weekly": 7, "biweekly": 14}
REPORT_LOOKBACK_DEFAULT = 120
RUN_LOOKBACK_DAYS = {
    "daily": 2, "every_2_days": 4, "weekly": 8, "biweekly": 15, "monthly": 35, "quarterly": 125,
}
RUN_LOOKBACK_DEFAULT = 2
MONITOR_WORKFLOWS = ["R2 CSV Monitor", "Monitor Categories", "monitor"]
MISSING_LABELS = ["—", "-", "None", "null", "N/A", "n/a"]
WORKFLOW_ARROW = " → "

# --- fixed values: image hosts that refuse downloads -------------------------------------------------
BLOCKED_IMAGE_HOSTS = [
    "lh3.googleusercontent.com", "lh4.googleusercontent.com", "lh5.googleusercontent.com",
    "gps-cs-s", "gps-proxy",
]

# --- fixed values: exported headers of a used-vehicle listing ----------------------------------------
EXPORT_HEADERS = {
    "id": "Listing ID",
    "title": "Title",
    "slug": "Slug",
    "price": "Price",
    "phone": "Phone",
    "user_name": "User Name",
    "user_email": "User Email",
    "user_phone": "User Phone",
    "user_type": "User Type",
    "date_published": "Date Published",
    "date_relative": "Date Relative",
    "address": "Address",
    "full_address": "Full Address",
    "status": "Status",
    "images_count": "Images Count",
    "s3_images": "S3 Images",
    "description": "Description",
    "category": "Category",
    "views_no": "Views",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "specification_en": "Specification (EN)",
    "specification_ar": "Specification (AR)",
}
COMMERCIAL_COLUMN_ORDER = [
    "id", "title", "category_slug", "category_id", "phone", "whatsapp_phone", "views_count", "image",
    "s3_image_path", "target_url", "open_target_url", "is_landing", "url",
]
