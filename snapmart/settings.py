"""Fixed values and defaults of the content-observation model.

Everything in the first block decides results and therefore has to equal the
values of the system being matched.  All of it is passed to the operators as
arguments; no operator reads this module behind the caller's back.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (results depend on them; order matters where noted)
# --------------------------------------------------------------------------

# Post categories: first category with a hit wins.
POST_CATEGORIES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("refrigerator", ("tủ lạnh", "tu lanh", "tủ đông", "refrigerator", "fridge")),
    ("rice_cooker", ("nồi cơm điện", "noi com dien", "rice cooker")),
    ("washing_machine", ("máy giặt", "may giat", "washing machine")),
    ("tv", ("tivi", "tv", "ti vi", "smart tv")),
    ("air_fryer", ("nồi chiên không dầu", "air fryer", "lò nướng")),
    ("stove", ("bếp ga", "bep ga", "bếp từ", "bep tu")),
    ("vacuum", ("máy hút bụi", "may hut bui", "vacuum")),
    ("fan", ("quạt", "quat", "fan")),
    ("kettle", ("ấm siêu tốc", "am sieu toc", "ấm đun")),
    ("iron", ("bàn ủi", "ban ui", "iron")),
)

# Video categories: a different list in a different order.
VIDEO_CATEGORIES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("rice_cooker", ("nồi cơm điện", "noi com dien", "rice cooker")),
    ("refrigerator", ("tủ lạnh", "tu lanh", "tủ đông", "refrigerator")),
    ("washing_machine", ("máy giặt", "may giat", "washing machine")),
    ("stove", ("bếp", "bep", "stove", "bếp ga", "bếp từ")),
    ("fan", ("quạt", "quat", "fan")),
    ("kettle", ("ấm siêu tốc", "am sieu toc", "kettle", "ấm đun")),
    ("iron", ("bàn ủi", "ban ui", "iron")),
    ("vacuum", ("máy hút bụi", "may hut bui", "vacuum")),
    ("tv", ("tivi", "ti vi", "tv", "smart tv", "television")),
    ("oven", ("lò nướng", "lo nuong", "oven", "air fryer")),
)

DEFAULT_CATEGORY = "general"

# Video channels that are never kept (substring of the lower-cased title).
EXCLUDED_CHANNELS: tuple[str, ...] = ("yến nồi cơm điện",)

# Search phrase templates, in order; {kw} is the base keyword.
SHORT_TEMPLATES: tuple[str, ...] = (
    "{kw}",
    "review {kw}",
    "{kw} giá rẻ",
    "{kw} đáng mua 2025",
    "{kw} hot nhất",
    "{kw} chất lượng",
    "{kw} tốt nhất",
    "mua {kw}",
    "{kw} sale",
    "{kw} trending",
)
PRODUCT_TEMPLATES: tuple[str, ...] = (
    "{kw}",
    "{kw} giá rẻ",
    "{kw} tốt nhất",
    "mua {kw}",
    "{kw} sale",
    "{kw} hot",
    "{kw} 2025",
    "{kw} đáng mua",
    "{kw} review",
    "{kw} chất lượng",
)

# Prefixes some services put in front of JSON.
JSON_GUARDS: tuple[str, ...] = ("for (;;);", "while(1);", "while(true);")

# URL fragments that mark a response as a search result.
POST_URL_PART = "graphql"
SHORT_URL_PART = "/api/search/general/full/"
PRODUCT_URL_PART = "/api/v4/search/search_items"
MIN_BODY_CHARS = 10

# Platform labels used in ids and in the platform column.
POST_PLATFORM = "facebook"
VIDEO_PLATFORM = "youtube"
AUTHOR_ID_PREFIX = "fb_user_"
UNKNOWN_AUTHOR = "Unknown"
EXTRACTION_METHOD = "graphql"

# Table names: (master, history) per kind of entity.
POST_TABLES = ("posts", "metrics_snapshot")
VIDEO_TABLES = ("videos", "snapshots")
SHORT_TABLES = ("Video_Category", "Video_Category_Details_History")
PRODUCT_TABLES = ("Shopee_ProductCategory", "Shopee_ProductCategory_History")

LOCAL_ZONE = "Asia/Ho_Chi_Minh"
PRICE_SCALE = 100000
CAPTION_CHARS = 400
ERROR_CHARS = 100
SURROGATE_MODULUS = 1_000_000_000
TRENDING_POSTS_LIMIT = 20

# --------------------------------------------------------------------------
# TUNING (never changes a result)
# --------------------------------------------------------------------------

# A side is broadcast only after its size was measured to be below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Sub-groups used to trim a hot group before its final ranking.
SALT_BUCKETS = 16
