"""Fixed values that results depend on: word lists, patterns, bounds, weights. No logic."""

# Brands looked for in titles when a listing is parsed, in order (by substring).
TITLE_BRANDS = ["apple", "lenovo", "hp", "dell", "asus", "acer", "samsung", "msi", "infinix", "xiaomi", "redmibook", "realme", "honor", "microsoft", "lg", "primebook", "oneplus", "motorola", "nothing", "google", "sony", "boat", "noise", "boult"]

# Specification keys that say nothing of the product.
IGNORED_KEYS = [
    "customer support number", "customer care number", "customer support email", "customer care email", "registered name and address",
    "manufacturer/importer/marketer name & address", "importer name & address", "manufacturer name & address", "customer care contact person", "grievance officer",
    "installation & demo applicable", "installation and demo applicable", "croma service promise", "spec_brand_url", "brand_url_pdp", "spec_viewmore_btn",
    "flipkart", "minutes", "grocery", "travel", "supercoin", "explore plus", "delivery details", "similar products", "trending products", "location not set",
    "name and address of the manufacturer", "name and address of the packer", "name and address of the importer",
]
IGNORED_PARTS = ["customer support", "customer care", "grievance", "registered name", "service promise", "importer/marketer", "marketer name", "toll free", "installation & demo", "contact person", "delivery details", "similar products", "trending products", "location not set", "explore plus", "supercoin", "about us", "careers", "press", "stories", "help center", "corporate information", "mail us", "registered office"]

# Query parameters that identify a visit, not a page; so does any that begins with utm_.
TRACKING_PARAMETERS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "ref_", "tag", "tag_id", "fbclid", "gclid", "sr", "qid", "sprefix", "crid", "keywords", "_price", "_mrp"]

# Words in a listing link's text that mean an accessory (discovery).
DISCOVERY_ACCESSORIES = ["table", "stand", "sleeve", "bag", "cover", "case", "skin", "mat", "adapter", "cable", "charger", "cord", "hub", "dock", "splitter", "dongle", "stylus", "enclosure", "mouse", "cleaning", "cleaner", "backpack", "mount", "cooling pad", "tempered glass", "screen guard", "screen protector", "braided", "strap", "holder", "pouch"]

# Laptop identity.
LAPTOP_BRANDS = ["apple", "asus", "lenovo", "hp", "dell", "acer", "samsung", "msi", "primebook", "infinix", "xiaomi", "realme", "honor", "microsoft", "lg", "avita", "zebronics"]
LAPTOP_ALIASES = {"hewlett packard": "hp", "hewlett-packard": "hp", "lenovo (india)": "lenovo", "apple inc": "apple", "dell inc": "dell", "acer inc": "acer", "asus inc": "asus", "asustek": "asus"}
LAPTOP_FAMILIES = [
    (r"macbook\s+air", "macbook air"), (r"macbook\s+pro", "macbook pro"), (r"macbook\s+neo", "macbook neo"), (r"macbook", "macbook"),
    (r"rog\s+strix", "rog strix"), (r"rog\s+zephyrus", "rog zephyrus"), (r"tuf\s+(?:gaming\s+)?[af]\d+", "tuf gaming"), (r"tuf\s+gaming", "tuf gaming"),
    (r"vivobook\s+s\d+", "vivobook s"), (r"vivobook\s+pro", "vivobook pro"), (r"vivobook\s+go", "vivobook go"), (r"vivobook\s+\d+", "vivobook"), (r"vivobook", "vivobook"),
    (r"zenbook", "zenbook"), (r"expertbook", "expertbook"), (r"victus", "victus"), (r"omen\s+\d+", "omen"), (r"omen", "omen"), (r"omnibook\s+\d+", "omnibook"), (r"omnibook", "omnibook"),
    (r"pavilion\s+plus", "pavilion plus"), (r"pavilion\s+aero", "pavilion aero"), (r"pavilion", "pavilion"), (r"envy", "envy"), (r"spectre", "spectre"), (r"elitebook", "elitebook"), (r"probook", "probook"),
    (r"\bhp\s+1[45]s?\b", "hp 15"), (r"\bhp\s+25[05]\b", "hp 255"), (r"\bdell\s+1[45]\b", "inspiron"),
    (r"ideapad(?:\s+slim)?(?:\s+gaming)?(?:\s+pro)?(?:\s+\d+)?", "ideapad"), (r"thinkpad", "thinkpad"), (r"thinkbook\s+\d+", "thinkbook"), (r"thinkbook", "thinkbook"), (r"loq", "loq"),
    (r"legion\s+(?:pro\s+)?\d+", "legion"), (r"legion", "legion"), (r"yoga\s+(?:slim\s+)?\d+", "yoga"), (r"yoga", "yoga"), (r"nitro\s+v\s*\d*", "nitro"), (r"nitro\s*\d*", "nitro"), (r"nitro", "nitro"),
    (r"\blenovo\s+v\s*1[45]\b", "v15"), (r"\bv1[45]\s+g\d+\b", "v15"), (r"inspiron\s+\d+", "inspiron"), (r"inspiron", "inspiron"), (r"latitude\s+\d+", "latitude"), (r"latitude", "latitude"),
    (r"vostro\s+\d+", "vostro"), (r"vostro", "vostro"), (r"xps\s+\d+", "xps"), (r"xps", "xps"), (r"alienware", "alienware"), (r"dell\s+g\s*(?:series|\d+)", "g series"),
    (r"aspire\s+lite", "aspire lite"), (r"aspire\s+\d+", "aspire"), (r"aspire", "aspire"), (r"predator\s+helios", "predator helios"), (r"predator", "predator"), (r"swift\s+(?:go\s+)?\d+", "swift"), (r"swift", "swift"),
    (r"travellite", "travellite"), (r"travelmate", "travelmate"), (r"extensa", "extensa"), (r"chromebook", "chromebook"), (r"galaxy\s+book\s*\d*(?:\s*pro)?(?:\s*360)?", "galaxy book"), (r"primebook\s*[a-z0-9]*", "primebook"),
]
LAPTOP_RAM_GB = [4, 8, 12, 16, 18, 24, 32, 36, 48, 64, 96, 128]
LAPTOP_STORAGE_GB = [32, 64, 128, 256, 512, 1024, 2048]
LAPTOP_BOUNDS = {"ram_gb": (1, 256), "storage_gb": (16, 16384), "screen_size_inches": (9.0, 24.0), "refresh_rate_hz": (30, 360), "gpu_vram_gb": (1, 48), "weight_kg": (0.5, 10.0), "battery_wh": (10.0, 150.0)}

# Chips in lower-case laptop titles, in order; the group is what counts.
LAPTOP_CHIPS = {
    "apple": r"\b((?:m[1-5]|a1[7-9])(?:\s+(?:pro|max|ultra))?)\b",
    "core_ultra": r"\b(intel\s+core\s+ultra\s+[579](?:\s+\d{3,4}[a-z]*)?|core\s+ultra\s+[579](?:\s+\d{3,4}[a-z]*)?|core\s+[3579]\s+\d{3,4}[a-z]*)\b",
    "core_i_sku": r"\b((?:intel\s+)?(?:core\s+)?i[3579][-\s]*(?:[0-9]{1,2}(?:th|nd|rd|st)\s+gen\s+)?([0-9]{4,5}[a-z]{0,2}))\b",
    "core_i_tier": r"\b((?:intel\s+)?(?:core\s+)?(i[3579]))\b(?:\s+(\d{1,2}(?:th|nd|rd|st)\s+gen))?",
    "ryzen_sku": r"\b(ryzen\s+(?:ai\s+)?[3579]\s+([0-9]{3,4}[a-z]{0,2}))\b",
    "ryzen_tier": r"\b(ryzen\s+[3579]|athlon\s*\w*)\b",
    "mediatek": r"\b(mediatek\s+(?:helio\s+[a-z0-9]+|kompanio\s+\d+|mt[0-9]{4}[a-z]*)|helio\s+[a-z0-9]+|kompanio\s+\d+|mt[0-9]{4}[a-z]*)\b",
    "intel_other": r"\b(celeron\s*\w*|pentium\s*\w*|intel\s+processor\s+n\d+|n\d{3,4})\b",
    "snapdragon": r"\b(snapdragon\s+x\s+(?:elite|plus|processor)|\bsnapdragon\s+x\b)\b",
}

# Mobile identity.
MOBILE_BRANDS = ["apple", "samsung", "oneplus", "xiaomi", "redmi", "poco", "realme", "vivo", "iqoo", "oppo", "google", "motorola", "nothing", "cmf", "infinix", "tecno", "lava", "honor", "asus", "nokia"]
MOBILE_ALIASES = {"apple inc": "apple", "samsung electronics": "samsung", "google pixel": "google", "moto": "motorola", "nothing phone": "nothing", "redmi by xiaomi": "redmi", "poco by xiaomi": "poco"}
MOBILE_FAMILIES = [
    (r"iphone\s+1[1-9]\s+pro\s+max", "iphone pro max"), (r"iphone\s+1[1-9]\s+pro", "iphone pro"), (r"iphone\s+1[1-9]\s+plus", "iphone plus"), (r"iphone\s+1[1-9]e?", "iphone"), (r"iphone\s+air", "iphone air"), (r"iphone\s+se\s*\d*", "iphone se"),
    (r"galaxy\s+s2[0-6]\s+ultra", "galaxy s ultra"), (r"galaxy\s+s2[0-6]\s+plus", "galaxy s plus"), (r"galaxy\s+s2[0-6]\s+fe", "galaxy s fe"), (r"galaxy\s+s2[0-6]", "galaxy s"),
    (r"galaxy\s+z\s+fold\s*\d*", "galaxy z fold"), (r"galaxy\s+z\s+flip\s*\d*", "galaxy z flip"), (r"galaxy\s+a\d{2}", "galaxy a"), (r"galaxy\s+m\d{2}", "galaxy m"), (r"galaxy\s+f\d{2}", "galaxy f"),
    (r"pixel\s+[6-9]\s+pro", "pixel pro"), (r"pixel\s+[6-9]\s+a", "pixel a"), (r"pixel\s+[6-9]", "pixel"),
    (r"oneplus\s+1[1-4]r", "oneplus r"), (r"oneplus\s+1[1-4]", "oneplus number"), (r"oneplus\s+nord\s+ce\s*\d*", "oneplus nord ce"), (r"oneplus\s+nord\s*\d*", "oneplus nord"), (r"oneplus\s+open", "oneplus open"),
    (r"redmi\s+note\s+\d+\s+pro\+?", "redmi note pro"), (r"redmi\s+note\s+\d+", "redmi note"), (r"redmi\s+turbo\s+\d+", "redmi turbo"), (r"redmi\s+a\d+\s+pro", "redmi a pro"), (r"redmi\s+a\d+", "redmi a"), (r"redmi\s+k\d+", "redmi k"), (r"redmi\s+\d+[a-z]*", "redmi number"),
    (r"realme\s+gt\s+\d+", "realme gt"), (r"realme\s+narzo\s+\d+\s*(?:pro|lite|speed)?", "realme narzo"), (r"realme\s+p\d+[a-z]*\s*(?:pro|lite)?", "realme p"), (r"realme\s+\d+\s+pro\+?", "realme number pro"), (r"realme\s+\d+[a-z]*", "realme number"),
    (r"poco\s+f\d+\s+pro", "poco f pro"), (r"poco\s+f\d+", "poco f"), (r"poco\s+x\d+\s+pro", "poco x pro"), (r"poco\s+x\d+", "poco x"), (r"poco\s+m\d+\s*(?:pro|power)?", "poco m"), (r"poco\s+c\d+[a-z]*", "poco c"),
    (r"iqoo\s+1[1-9]r?", "iqoo number"), (r"iqoo\s+neo\s*\d*", "iqoo neo"), (r"iqoo\s+z\d*", "iqoo z"),
    (r"vivo\s+x\d+t?\s*pro\+?", "vivo x pro"), (r"vivo\s+x\d+t?", "vivo x"), (r"vivo\s+v\d+\s*pro\+?", "vivo v pro"), (r"vivo\s+v\d+", "vivo v"), (r"vivo\s+t\d+", "vivo t"), (r"vivo\s+y\d+", "vivo y"),
    (r"nothing\s+phone\s*\([123a]+\)", "nothing phone"), (r"cmf\s+phone\s*\d*", "cmf phone"),
    (r"motorola\s+edge\s+\d+\s*pro", "motorola edge pro"), (r"motorola\s+edge\s+\d+\s*(?:fusion|ultra)?", "motorola edge"), (r"motorola\s+g\d+\s*(?:power)?", "moto g"), (r"moto\s+g\d+\s*(?:power)?", "moto g"),
]
MOBILE_CHIPS = {
    "apple": r"\b(a1[4-9](?:\s+pro)?(?:\s+bionic)?)\b",
    "snapdragon": r"\b(snapdragon\s+(?:8\s+gen\s+[1-5]|7\s+gen\s+[1-4]|6s?\s+gen\s+\d|4\s+gen\s+\d|8[5-8]\d|7\d{2}[a-z]?|\d{3,4}))\b",
    "dimensity": r"\b(dimensity\s+(?:9\d{3}|8\d{3}|7\d{3}|6\d{3}|[1-9]\d{2}[a-z]?))\b",
    "tensor": r"\b(tensor\s+g[1-5])\b",
    "unisoc": r"\b(unisoc\s+(?:t\d{3,4}|octa-core|\w+))\b",
}
MOBILE_COLORS = ["desert titanium", "natural titanium", "white titanium", "black titanium", "titanium gray", "titanium black", "phantom black", "marble gray", "cobalt violet", "amber yellow", "onyx black", "obsidian", "porcelain", "hazel", "bay", "rose", "midnight", "starlight", "space black", "space gray", "emerald green", "silver", "gold", "black", "blue", "green", "purple", "pink", "white", "yellow"]
MOBILE_BOUNDS = {"ram_gb": (1, 32), "storage_gb": (1, 2048), "screen_size_inches": (1.5, 8.5), "refresh_rate_hz": (30, 240), "primary_camera_mp": (2, 300), "front_camera_mp": (2, 100), "battery_mah": (500, 15000), "fast_charging_w": (5, 300), "peak_brightness_nits": (100, 10000), "weight_grams": (50.0, 600.0)}

# Quality gate: patterns of accessories, price bands in paise, points of completeness.
ACCESSORIES = [
    r"\b(?:laptop|phone|macbook|iphone|galaxy|ipad)\s+(?:case|cover|sleeve|skin|bag|backpack|stand|mount|pouch|holder)\b",
    r"\b(?:tempered\s+glass|screen\s+protector|back\s+cover|flip\s+cover|bumper\s+case)\b",
    r"\b(?:power\s+adapter|charger|charging\s+cable|usb\s+cable|hdmi\s+cable|lightning\s+cable|type-c\s+cable)\b",
    r"\b(?:cooling\s+pad|keyboard\s+cover|keyboard\s+skin|keypad\s+skin|trackpad\s+protector|cleaning\s+kit|cleaner)\b",
    r"\b(?:stylus\s+pen|stylus|camera\s+lens\s+protector|dust\s+plug|protective\s+sticker)\b",
    r"\b(?:wireless\s+mouse|optical\s+mouse|bluetooth\s+mouse|gaming\s+mouse|mouse\s+pad|desk\s+mat|table\s+mat)\b",
    r"\b(?:mechanical\s+keyboard|wireless\s+keyboard|bluetooth\s+keyboard|usb\s+hub|docking\s+station|laptop\s+riser)\b",
    r"\b(?:earphones|headphones|earbuds|headset|neckband|smartwatch\s+strap|watch\s+band)\b",
]
PRICE_BANDS = {"laptop": (1_000_000, 100_000_000), "mobile": (250_000, 35_000_000)}

# Taxonomy.
TAXONOMY = {
    "laptop": {
        "department": "electronics", "label": "Laptop", "identity": ["cpu_model", "gpu_model", "ram_gb", "storage_gb"],
        "subcategories": {"gaming_laptop": "Gaming laptop", "business_laptop": "Business laptop", "thin_and_light_laptop": "Thin and light laptop", "two_in_one_laptop": "2-in-1 laptop", "student_laptop": "Student laptop", "chromebook": "Chromebook"},
        "aspects": ["performance", "battery", "thermals", "display", "build", "reliability", "keyboard", "trackpad", "weight", "fan_noise", "webcam", "speakers", "ports", "gaming", "upgradeability"],
    },
    "mobile": {
        "department": "electronics", "label": "Mobile Phone", "identity": ["chipset", "ram_gb", "storage_gb", "color"],
        "subcategories": {"flagship": "Flagship smartphone", "mid_range": "Mid-range smartphone", "budget": "Budget smartphone", "foldable": "Foldable phone", "gaming_phone": "Gaming phone"},
        "aspects": ["camera", "battery", "performance", "display", "build", "software", "charging", "audio"],
    },
}
RETAILER_CATEGORIES = {"amazon": ["laptop", "mobile"], "flipkart": ["laptop", "mobile"], "croma": ["laptop", "mobile"]}
RETAILER_HOSTS = {"amazon": ["www.amazon.in", "amazon.in"], "flipkart": ["www.flipkart.com", "flipkart.com"], "croma": ["www.croma.com", "croma.com"]}

# Operations.
PROFILES = [("smoke", 5, 5, 5, 1, 2.0), ("shadow", 25, 10, 10, 1, 2.0), ("incremental", 100, 25, 25, 2, 2.0), ("backfill", 500, 50, 50, 2, 2.0)]
LIFECYCLES = ["ACTIVE", "STALE", "UNAVAILABLE", "DISCONTINUED"]
PRODUCT_ID_PATTERNS = {
    "amazon": [r"(?i)/dp/([A-Z0-9]{10})", r"(?i)/gp/product/([A-Z0-9]{10})"],
    "flipkart": [r"(?i)/p/(itm[a-zA-Z0-9]{13,16})", r"(?i)pid=([A-Z0-9]{16})"],
    "croma": [r"(?i)/p/(\d{6})", r"(?i)productCode=(\d{6})"],
}
LAPTOP_URL_WORDS = ["laptop", "macbook", "notebook", "chromebook", "vivobook", "zenbook", "thinkpad", "ideapad", "inspiron", "victus", "omen", "legion"]
