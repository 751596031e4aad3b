"""Specifications and titles to typed attributes, from rule tables.

A field's rule: keys in order (the first whose value parses counts), how a value is parsed, then what a title says. Tables hold what
differs between fields; they are compiled to one Column each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import Keyed, built, first_key, first_pattern, first_present, first_words, get, map_of, ordered, overlay, refold
from ..functions.text import any_word, capacity_gb, cm_to_inch, first_capacity, first_of, fold, group, has_any, is_ignored_key, nonblank, text_norm, weight_kg, within
from .identity import staged

Parse = Callable[[Column], Column]
Words = list[tuple[list[str], str]]


def raw(c: Column) -> Column:
    return F.trim(c)


def capacity(c: Column) -> Column:
    return capacity_gb(first_capacity(c))


def words(rules: Words) -> Parse:
    return lambda c: first_words(F.lower(c), rules)


def number(pattern: str, low: float, high: float, kind: str = "double") -> Parse:
    return lambda c: within(group(F.lower(c), pattern).try_cast(kind), low, high)


def _max_of(pattern: str, bare: str, low: int, high: int) -> Parse:
    """The largest of the numbers that the pattern finds, or else of the bare ones, within bounds."""

    def parse(c: Column) -> Column:
        found = lambda p: F.transform(F.regexp_extract_all(F.lower(c), F.lit(p), F.lit(1)), lambda x: x.cast("int"))
        marked = found(pattern)
        return F.array_max(F.filter(F.when(F.size(marked) > 0, marked).otherwise(found(bare)), lambda x: x.between(low, high)))

    return parse


# Words that name a value, in order.
RAM_TYPES: Words = [(["ddr5"], "DDR5"), (["ddr4"], "DDR4"), (["unified"], "Unified Memory")]
DRIVES: Words = [(["emmc"], "eMMC"), (["ssd", "nvme"], "SSD"), (["hdd", "hard disk"], "HDD")]
LAPTOP_PANELS: Words = [(["oled"], "OLED"), (["ips"], "IPS LCD"), (["led"], "LED")]
WEBCAMS: Words = [(["1080p", "fhd"], "1080p FHD"), (["720p", "hd"], "720p HD")]
WIFI: Words = [(["wi-fi 7", "wifi 7", "802.11be"], "Wi-Fi 7"), (["wi-fi 6e", "wifi 6e"], "Wi-Fi 6E"), (["wi-fi 6", "wifi 6", "802.11ax", "ax"], "Wi-Fi 6"), (["wi-fi 5", "wifi 5", "802.11ac"], "Wi-Fi 5")]
LAPTOP_RESOLUTIONS: Words = [(["4k", "3840"], "4K UHD"), (["2.8k", "2880"], "2.8K"), (["2.5k", "2560"], "2.5K QHD"), (["wuxga", "1920 x 1200", "1920x1200"], "WUXGA"), (["1080", "fhd", "full hd"], "FHD"), (["720", "hd"], "HD")]
MOBILE_PANELS: Words = [(["super amoled"], "Super AMOLED"), (["amoled"], "AMOLED"), (["super retina", "xdr"], "Super Retina XDR"), (["oled"], "OLED"), (["ips"], "IPS LCD"), (["lcd"], "LCD")]
MOBILE_RESOLUTIONS: Words = [(["4k", "3840"], "4K UHD"), (["qhd+", "2560", "3120"], "QHD+"), (["1.5k", "1220", "1272"], "1.5K"), (["fhd+", "full hd+", "2400", "1080"], "FHD+"), (["hd+", "1600", "720"], "HD+")]
CAMERA_SETUPS: Words = [(["quad"], "Quad Camera"), (["triple"], "Triple Camera"), (["dual"], "Dual Camera"), (["single"], "Single Camera")]
BIOMETRICS: Words = [(["in-display", "in display"], "In-Display Fingerprint"), (["side-mounted", "side fingerprint"], "Side Fingerprint"), (["face id"], "Face ID"), (["fingerprint"], "Fingerprint Sensor")]
IP = r"\b(ip6[89]|ip6[57]|ip5[45]|ip53)\b"
NOTHING = ["not available", "na", "null", "none"]

# Fixed values: (keys in order, parse) of each field.
LAPTOP_RULES: dict[str, tuple[list[str], Parse]] = {
    "ram_gb": (["ram", "ram size", "system memory", "ram capacity", "internal memory", "ram memory installed", "ram memory maximum size", "memory"], capacity),
    "storage_gb": (["storage", "ssd capacity", "hard drive size", "hdd capacity", "ssd", "emmc capacity", "hard disk description", "hard disk size", "storage capacity", "hard drive capacity"], capacity),
    "storage_type": (["hard disk description", "storage type", "drive type", "hard drive interface"], words(DRIVES)),
    "gpu_model": (["graphic processor", "graphics processor", "graphics coprocessor", "graphics card description", "gpu", "gpu model", "graphics", "video processor", "graphics description", "dedicated graphic memory capacity", "dedicated graphic card"], raw),
    "ram_type": (["ram type", "type of ram", "memory technology", "ram memory technology", "system ram type"], lambda c: F.coalesce(first_words(F.lower(c), RAM_TYPES), F.upper(F.trim(c)))),
    "operating_system": (["operating system", "os"], raw),
    "color": (["brand color", "colour", "color"], raw),
    "display_type": (["display type"], words(LAPTOP_PANELS)),
    "webcam_resolution": (["web camera", "camera resolution", "camera", "webcam", "laptop camera type", "other special features of the product"], words(WEBCAMS)),
    "weight_kg": (["weight", "product weight", "item weight", "package weight"], weight_kg),
    "battery_wh": (["battery cell", "battery", "battery capacity", "standard battery life", "laptop battery", "lithium battery energy content"], number(r"(\d{2,3}(?:\.\d)?)\s*(?:wh|watt\s*hours)", 10.0, 150.0)),
    "wifi_standard": (["wireless lan", "wifi specifications", "wi-fi specifications", "network connectivity", "wi-fi generation", "computer wireless type", "wireless technology"], words(WIFI)),
    "display_resolution": (["screen resolution", "screen resolution type", "display resolution", "native resolution", "maximum display resolution", "scanner resolution", "additional screen specifications"], words(LAPTOP_RESOLUTIONS)),
    "mpn": (["manufacturer part number", "part number"], raw),
    "model_number": (["model number", "model name"], raw),
    "asin": (["asin"], raw),
    "warranty": (["warranty description", "warranty", "warranty type"], raw),
}
MOBILE_RULES: dict[str, tuple[list[str], Parse]] = {
    "ram_gb": (["ram", "ram capacity", "internal memory", "ram memory installed size", "system memory", "installed ram", "system ram type"], capacity),
    "storage_gb": (["internal storage", "storage", "rom", "storage capacity", "memory storage capacity", "capacity"], capacity),
    "color": (["brand color", "color", "colour"], raw),
    "network_type": (["cellular technology", "network type", "supported networks", "network connectivity"], words([(["5g"], "5G"), (["4g", "lte"], "4G")])),
    "display_type": (["display type", "screen type", "resolution type", "panel type"], words(MOBILE_PANELS)),
    "refresh_rate_hz": (["refresh rate", "standard refresh rate", "display refresh rate"], lambda c: group(c, r"\b(60|90|120|144|165)\b").try_cast("int")),
    "primary_camera_mp": (["camera", "primary camera", "rear camera", "main camera", "rear camera setup"], _max_of(r"\b(\d{1,3})\s*(?:mp|megapixel|mega pixel)\b", r"\b(200|108|64|50|48|32|13|12|8|5)\b", 5, 200)),
    "front_camera_mp": (["secondary camera", "front camera", "front camera setup", "selfie camera"], _max_of(r"\b(\d{1,3})\s*(?:mp|megapixel|mega pixel)\b", r"\b(50|32|20|16|13|12|8|5)\b", 4, 64)),
    "battery_mah": (["battery capacity", "battery", "battery size"], lambda c: within(F.coalesce(group(F.lower(c), r"(\d{3,5})\s*mah"), group(c, r"\b([1-9][0-9]{3})\b")).try_cast("int"), 500, 15000)),
    "fast_charging_w": (["additional charging features", "fast charging capability", "quick charging", "charging speed"], lambda c: group(F.lower(c), r"(\d{2,3})\s*w").try_cast("int")),
    "operating_system": (["os name & version", "operating system", "os type", "os"], raw),
    "resolution_standard": (["resolution", "screen resolution", "resolution type"], words(MOBILE_RESOLUTIONS)),
    "camera_setup": (["rear camera configuration", "main camera setup", "dual camera lens", "camera setup"], words(CAMERA_SETUPS)),
    "ois_supported": (["camera features", "primary camera features", "camera"], lambda c: F.when(has_any(F.lower(c), ["ois", "optical image"]), F.lit("true"))),
    "water_resistance_rating": (["ip rating", "water resistance", "resistance type"], lambda c: F.upper(group(F.lower(c), IP))),
    "screen_protection": (["screen protection", "protection", "glass protection"], raw),
    "biometrics": (["fingerprint sensor", "security", "lock", "sensors"], words(BIOMETRICS)),
    "sim_type": (["sim type", "number of sims supported", "secondary sim type", "dual sim mode"], raw),
    "weight_grams": (["product weight", "weight", "item weight"], number(r"(\d+(?:\.\d+)?)\s*g", 50.0, 600.0)),
    "mpn": (["model number", "item model number", "model series", "part number", "specialsku"], raw),
    "asin": (["asin"], raw),
    "gtin": (["ean", "gtin", "upc"], raw),
    "warranty": (["warranty summary", "warranty on main product", "warranty description", "warranty"], raw),
}
# What titles say, and the patterns within laptop_attributes and mobile_attributes.
LAPTOP_TITLE_CPU = r"(?i)\b(Apple\s+M[1-5](?:\s+(?:Pro|Max|Ultra))?|M[1-5](?:\s+(?:Pro|Max|Ultra))?(?:\s+chip)?|Intel\s+Core\s+(?:Ultra\s+)?[i3579]-?\w*|AMD\s+Ryzen\s+[3579]-?\w+|Snapdragon\s+X\s+\w+|MediaTek\s+\w+)\b"
LAPTOP_TITLE_GPU = r"(?i)\b(NVIDIA\s+GeForce\s+RTX\s+\d+(?:\s*Ti)?|NVIDIA\s+RTX\s+\d+|Intel\s+Arc\s+\w+|Intel\s+Iris\s+Xe|AMD\s+Radeon\s+\w+|Intel\s+iGPU)\b"
APPLE_M = r"(?i)\b(M[1-5](?:\s+(?:Pro|Max|Ultra))?)\b"
MOBILE_TITLE_CHIP = r"(?i)\b(Snapdragon\s+(?:8\s+Gen\s+[1-5]|7\s+Gen\s+[1-4]|6s?\s+Gen\s+\d|4\s+Gen\s+\d|8[5-8]\d|7\d{2}[a-z]?|\d{3,4})|Dimensity\s+(?:9\d{3}|8\d{3}|7\d{3}|6\d{3}|[1-9]\d{2}[a-z]?)|Tensor\s+G[1-5]|Unisoc\s+(?:T\d{3,4}|\w+)|Helio\s+[A-Z]\d{2,3})\b"


def _from_rules(rules: dict[str, tuple[list[str], Parse]], specs: Column) -> dict[str, Column]:
    return {k: first_key(specs, keys, parse) for k, (keys, parse) in rules.items()}


def _squeezed(c: Column) -> Column:
    return nonblank(F.trim(F.regexp_replace(c, r"\s+", " ")))


def laptop_attributes(title: Column, specs: Column) -> dict[str, Column]:
    t = fold(title)
    has = lambda k: get(specs, k).isNotNull()
    apple = t.contains("macbook") | t.contains("apple")
    f = _from_rules(LAPTOP_RULES, specs)
    cap = lambda what: capacity_gb(group(title, rf"(?i)(\d+\s*(?:GB|TB))\s+(?:{what})"))
    models = ["cpu model number", "processor name", "cpu model", "processor type"]
    own = F.trim(F.concat_ws(" ", first_of(*[get(specs, k) for k in models]), get(specs, "processor variant")))
    brand = get(specs, "processor brand")
    own = F.when((brand != "") & ~F.lower(own).contains(F.lower(brand)), F.concat_ws(" ", brand, own)).otherwise(own)
    any_model = has(models[0]) | has(models[1]) | has(models[2]) | has(models[3])
    plain = first_key(specs, ["processor", "cpu", "processor variant", "processor brand", "processor speed", "chipset"], raw)
    title_cpu = F.trim(F.regexp_replace(group(title, LAPTOP_TITLE_CPU), r"(?i)\s+chip$", ""))
    screen = first_key(specs, ["screen size", "display size", "screen size (in inches)", "display size (in inches)", "display size (in cms)", "display"], lambda c: within(F.when(group(c, r"(\d{1,2}(?:\.\d{1,2})?)").try_cast("double") > 24, cm_to_inch(group(c, r"(\d{1,2}(?:\.\d{1,2})?)").try_cast("double"), 1)).otherwise(group(c, r"(\d{1,2}(?:\.\d{1,2})?)").try_cast("double")), 9.0, 24.0))
    lit_keys = ["type of keyboard", "keyboard description", "keyboard", "other special features of the product", "special features"]
    said = F.lower(get(specs, "backlit keyboard"))
    backlit = ordered([(said.isin("yes", "true", "1"), F.lit("True")), (said.isin("no", "false", "0"), F.lit("False")), (said.isNull() & (t.contains("backlit") | F.lower(F.concat_ws(" ", *[get(specs, k) for k in lit_keys])).contains("backlit")), F.lit("True"))])
    return f | {
        "ram_gb": F.coalesce(f["ram_gb"], cap("RAM|DDR|LPDDR|Memory")), "storage_gb": F.coalesce(f["storage_gb"], cap("SSD|HDD|ROM|NVMe|Storage|EMMC")),
        "storage_type": F.coalesce(f["storage_type"], ordered([(has("ssd capacity") | has("ssd") | t.contains("ssd"), F.lit("SSD")), (t.contains("emmc") | has("emmc capacity"), F.lit("eMMC")), (t.contains("hdd") | has("hdd capacity"), F.lit("HDD"))])),
        "cpu_model": F.when(any_model, F.coalesce(_squeezed(F.regexp_replace(own, r"(?i)\bprocessor\b", "")), F.lit(""))).otherwise(F.coalesce(plain, title_cpu, F.when(apple, F.concat(F.lit("Apple "), group(title, APPLE_M))))),
        "gpu_model": F.coalesce(f["gpu_model"], group(title, LAPTOP_TITLE_GPU), F.when(apple, F.concat(F.lit("Apple "), group(title, APPLE_M), F.lit(" GPU")))),
        "screen_size_inches": F.coalesce(screen, group(title, r"(?i)(\d{2}(?:\.\d{1,2})?)\s*(?:inch|inches|\"|-inch)").try_cast("double")),
        "keyboard_backlight": backlit,
    }


def mobile_attributes(title: Column, specs: Column) -> dict[str, Column]:
    t = fold(title)
    f = _from_rules(MOBILE_RULES, specs)
    some = lambda c: F.when(~F.lower(F.trim(c)).isin(NOTHING), nonblank(F.trim(c)))
    brand = some(get(specs, "processor brand"))
    name = first_of(*[get(specs, k) for k in ("processor name", "processor type", "processor", "chipset", "cpu model")])
    name = F.coalesce(some(name), F.when(F.lower(F.trim(name)).isin(NOTHING), some(get(specs, "processor"))))
    chip = F.when(brand.isNotNull() & ~F.lower(name).contains(F.lower(brand)), F.concat_ws(" ", brand, name)).otherwise(name)
    chip = F.regexp_replace(chip, r"(?i)\b(?:processor|octa-core|octa core|quad-core|quad core|dual-core|dual core|[\d.]+\s*ghz)\b", "")
    chip = some(_squeezed(F.regexp_replace(F.trim(chip), r",\s*$", "")))
    bionic = F.initcap(F.trim(F.regexp_replace(group(t, r"\b(a1[4-9](?:\s+pro)?(?:\s+bionic)?(?:\s+chip)?)\b"), r"\s+chip$", "")))
    inch = r"(\d+(?:\.\d+)?)\s*(?:in|inch|inches|\"|″|-inch)"
    cm = lambda c, p: within(cm_to_inch(group(F.lower(c), p).try_cast("double"), 2), 1.5, 8.5)
    bare = r"^\s*(\d+(?:\.\d+)?)\s*$"
    size = lambda c: F.coalesce(number(inch, 1.5, 8.5)(c), cm(c, r"(\d+(?:\.\d+)?)\s*cm"), number(bare, 1.5, 8.5)(c), F.when(group(c, bare).try_cast("double") > 8.5, cm(c, bare)))
    screens = ["screen size in inches", "screen size (in inches)", "display size (in inches)", "display size", "screen size", "screen size in cm", "display size in cm"]
    ask = lambda p: group(t, p).try_cast("int")
    jack = first_present(specs, ["audio jack", "audio jack port", "headphone jack"], lambda c: first_words(F.lower(c), [(["3.5", "yes"], "True"), (["no", "type-c", "usb"], "False")]))
    return f | {
        "ram_gb": F.coalesce(f["ram_gb"], ask(r"\b([23468]|12|16|24)\s*gb(?:\s+ram)?\b").cast("long")),
        "storage_gb": F.coalesce(f["storage_gb"], F.when(t.contains("1tb") | t.contains("1 tb"), F.lit(1024).cast("long")), ask(r"\b(32|64|128|256|512)\s*gb(?:\s+(?:rom|storage|internal\s+storage))?\b").cast("long")),
        "chipset": F.coalesce(chip, nonblank(bionic), group(title, MOBILE_TITLE_CHIP)),
        "color": F.coalesce(f["color"], first_pattern(t, [(any_word([c]), c.title()) for c in fixed.MOBILE_COLORS])),
        "network_type": F.coalesce(f["network_type"], F.when(t.contains("5g"), F.lit("5G")).otherwise(F.lit("4G"))),
        "screen_size_inches": F.coalesce(first_key(specs, screens, size), group(t, r"([2-7](?:\.[0-9]{1,2})?)\s*(?:in|inch|inches|\"|″|-inch)").try_cast("double"), cm(title, r"(\d{1,2}(?:\.\d{1,2})?)\s*cm")),
        "display_type": F.coalesce(f["display_type"], first_words(t, [(["super retina", "xdr"], "Super Retina XDR"), (["amoled"], "AMOLED"), (["oled"], "OLED")])),
        "refresh_rate_hz": F.coalesce(f["refresh_rate_hz"], ask(r"\b(60|90|120|144|165)\s*hz\b")),
        "primary_camera_mp": F.coalesce(f["primary_camera_mp"], ask(r"\b(200|108|64|50|48|32|13|12|8|5)\s*mp\b")),
        "battery_mah": F.coalesce(f["battery_mah"], ask(r"\b([1-9][0-9]{3})\s*mah\b")),
        "fast_charging_w": F.coalesce(f["fast_charging_w"], ask(r"\b(\d{2,3})\s*w\s*(?:charging|fast|supervooc|hypercharge|turbopower|dart)?\b")),
        "operating_system": F.coalesce(f["operating_system"], F.when(has_any(t, ["iphone", "apple", "ios"]), F.lit("iOS")).otherwise(F.lit("Android"))),
        "ois_supported": F.when(f["ois_supported"].isNotNull() | t.contains("ois"), F.lit("True")),
        "water_resistance_rating": F.coalesce(f["water_resistance_rating"], F.upper(group(t, IP))),
        "screen_protection": F.coalesce(f["screen_protection"], first_words(t, [(["ceramic shield", "iphone"], "Ceramic Shield"), (["victus 2"], "Gorilla Glass Victus 2"), (["victus"], "Gorilla Glass Victus")])),
        "audio_jack_3_5mm": jack, "model_number": f["mpn"], "ean": f["gtin"],
    }


def with_attributes(listings: DataFrame) -> DataFrame:
    """listings (category, title, specs map) with attributes: the specifications that mean something, by folded key, and what is typed (which wins)."""
    d = staged(listings, lambda: {"n_": refold(F.col("specs"), text_norm)}, lambda: {"n_": F.map_filter(F.col("n_"), lambda k, _: ~is_ignored_key(k))}, name="attributes")
    code, kinds = F.lower(F.trim("category")), {}
    for name, build, of in (("l_", laptop_attributes, code == "laptop"), ("m_", mobile_attributes, code.isin("mobile", "smartphone", "phone"))):
        # Values of keys, then fields, then their map: each a step, so that nothing is worked out twice, and only for the category's rows.
        def make(name: str = name, build: Callable[..., dict[str, Column]] = build, of: Column = of) -> tuple[Keyed, dict[str, tuple[str, Column]]]:
            values = Keyed(f"{name}k")
            return values, {k: (f"{name}{i}", F.when(of, c)) for i, (k, c) in enumerate(build(F.col("title"), values).items())}

        values, fields = built(make, "attribute fields", name)
        d = staged(d, lambda: {c: F.when(of, v) for c, v in values.values(F.col("n_")).items()}, lambda: dict(fields.values()), lambda: {name: F.when(of, map_of({k: F.col(c) for k, (c, _) in fields.items()}))}, name=f"attributes {name}")  # noqa: B023
        d = d.drop(*values.names.values(), *[c for c, _ in fields.values()])
        kinds[name] = of
    typed = ordered([(of, F.col(name)) for name, of in kinds.items()], F.create_map().cast("map<string,string>"))
    plain = F.transform_values(F.col("n_"), lambda _, v: F.trim(v))
    d = staged(d, lambda: {"typed_": typed, "plain_": plain})
    return d.withColumn("attributes", overlay(F.col("plain_"), F.col("typed_"))).drop("n_", "l_", "m_", "typed_", "plain_")
