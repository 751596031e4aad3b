"""Queries of identity with their SQL: fingerprints of laptops and phones whose titles and specifications are made of part's keys."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.spread import spread
from ..operators import identity
from .queries import query, table
from .sample import Field, cases, columns, field, first_label, first_words, fold, group, norm, selects

LAPTOP_TITLE = {
    "a": field("Apple", "ASUS", "Lenovo", "HP", "Dell", "acer", "Samsung", "MSI", "Hewlett-Packard", "Infinix", "Straße", None),
    "b": field("MacBook Air", "Vivobook S15", "ThinkPad E14", "Victus", "Inspiron 3520", "Aspire Lite", "Galaxy Book4 Pro 360", "Swift Go 14", "TUF Gaming A15", "IdeaPad Slim 3", "LOQ", "Nitro V 15", "Lenovo V15 G4", None, step=2),
    "c": field("M3 Pro", "Intel Core Ultra 7 155H", "Core i5-1235U", "i7 13th Gen 13620H", "Core i3 12th Gen", "AMD Ryzen 5 7520U", "Ryzen AI 7 350", "Ryzen 7", "Athlon Silver", "MediaTek Kompanio 520", "Celeron N4500", "Snapdragon X Elite", "N100", None, None, step=3),
    "d": field("8GB", "16 GB DDR5", "24GB Unified Memory", "32 GB LPDDR5X RAM", "7GB", "4GB LPDDR4X", None, step=5, shift=1),
    "e": field("512GB SSD", "1TB", "2 TB SSD", "256 GB eMMC", "64GB", "300 GB", None, step=7),
    "f": field("15.6 inch", '14" Display', "39.62 cm", "13.3-inch", "17 cm", "(35.56 cm)", None, step=11),
    "g": field("NVIDIA GeForce RTX 4050", "RTX 3050 Ti", "Radeon RX 6500M", "Intel Arc A370M", "6GB Graphics", None, None, None, step=4),
    "h": field("Backlit Keyboard", "1.5 kg", "0.3 kg", "70 Wh", "FHD IPS", "2.8K OLED", "Liquid Retina XDR", "13th Generation", "QHD", "9.5 Wh", None, None, None, step=6, shift=2),
}
LAPTOP_SPECS = {
    "cpu_model": field(None, None, None, None, None, None, " Apple M2 Chip ", "", step=3), "processor name": field(None, "Core i7", " ", None, None, step=4), "processor variant": field("1355U", None, step=2), "processor brand": field("Intel", None, "AMD", step=5),
    "chipset": field("Exynos", None, None, step=8), "graphics": field("Intel UHD", None, None, "  ", step=6), "gpu_model": field(None, None, None, None, "Adreno 740", step=7), "ram": field("8 GB DDR4", None, "sixteen", step=3), "ram_gb": field(None, None, None, None, None, "64", "x", "512", step=9),
    "ssd capacity": field("256 GB", None, "1 TB", step=4), "storage": field(None, None, "none", step=5), "screen size": field("15.6 Inches", "35.56", None, "40 cm", "8", step=3, shift=1), "weight": field("1 kg 880 g", "1.65 Kg", None, "20 kg", step=6), "item weight": field("2.1 kg", None, step=7),
    "battery": field("42 Wh", "3 cell", None, "56.5 watt hours", step=8), "ram type": field("DDR4", None, "sdram", step=2), "features": field("Backlit", None, None, None, None, step=5), "refresh_rate_hz": field(None, None, None, None, "144", None, None, "999", step=10),
}
SAID = {"said": field(None, "ASUS", "dell inc", " Lenovo (India)", "Nobody", "acer", None, None, step=3), "name": field(None, None, "Own Name 5", "", "A name that is far too long to be anything but a title, as everybody can see at a glance", step=4), "mpn": field(None, None, None, "Ab-1 ", step=6), "gtin": field(None, None, None, None, "890", step=7)}
NUMBER = r"(\d+(?:\.\d+)?)"


def _frame(spark: SparkSession, d: str, code: str, title: dict[str, Field], specs: dict[str, Field]) -> DataFrame:
    p = spread(table(spark, d, "part").select("p_partkey"), "p_partkey").withColumns(columns(title) | columns(SAID))
    entries = [F.when(f.spark("p_partkey").isNotNull(), F.struct(F.lit(k).alias("key"), f.spark("p_partkey").alias("value"))) for k, f in specs.items()]
    rows = p.select(
        "p_partkey", F.lit(code).alias("category"), F.concat_ws(" ", *title).alias("title"), F.col("said").alias("brand"), F.col("name").alias("model_name"), F.col("mpn").alias("manufacturer_part_number"), "gtin",
        F.map_from_entries(F.array_compact(F.array(*entries))).alias("attributes"),
    )
    return identity.with_fingerprint(rows)


def _rows_sql(title: dict[str, Field], specs: dict[str, Field]) -> str:
    every = " || ' ' || ".join(f"coalesce('{k} ' || \"{k}\", '')" for k in specs)
    return f"""r0 AS (SELECT p_partkey, {selects(title)}, {selects(specs)}, {selects(SAID)} FROM part),
r AS (SELECT *, concat_ws(' ', {", ".join(title)}) AS title, {fold(every)} AS everything FROM r0), w AS (SELECT *, {fold("title")} AS t, {fold("concat_ws(' ', coalesce(name, ''), title)")} AS words FROM r)"""


def _brand(brands: list[str], aliases: dict[str, str]) -> str:
    s = fold("trim(said)")
    s = cases([(f"{s} = '{a}'", f"'{b}'") for a, b in aliases.items()], s)
    plain = lambda x: r"\b(?:" + re.sub(r"([()])", r"\\\1", x) + r")\b"
    known = ", ".join(f"'{b}'" for b in brands)
    return f"coalesce(CASE WHEN {s} IN ({known}) THEN {s} END, {first_label('t', [(plain(a), b) for a, b in aliases.items()] + [(plain(b), b) for b in brands])}, nullif(trim(regexp_split_to_array(trim(t), '\\s+')[1]), ''), 'unknown')"


def _first(keys: list[str], parse) -> str:  # noqa: ANN001
    return "coalesce(" + ", ".join(parse(f'"{k}"') for k in keys) + ")"


def _int(x: str) -> str:
    return f"try_cast({x} AS INT)"


def _double(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


def _within(x: str, low: float, high: float) -> str:
    return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN {x} END"


def _listed(pattern: str, allowed: list[int]) -> str:
    return f"list_filter(list_transform(regexp_extract_all(t, '{pattern}', 1), lambda x: x::INT), lambda x: x IN ({', '.join(map(str, allowed))}))[1]"


def _weight_kg(c: str) -> str:
    both = rf"(\d+)\s*kg\s*(\d+)\s*g"
    split = f"round({_double(group(f'lower({c})', both))} + {_double(group(f'lower({c})', both, 2))} / 1000, 2)"
    return f"coalesce({_within(split, 0.5, 10.0)}, {_within(_double(group(f'lower({c})', NUMBER + chr(92) + 's*kg')), 0.5, 10.0)})"


def _sound(bounds: dict[str, tuple[float, float]], typed: dict[str, str]) -> str:
    return " AND ".join(f"coalesce({typed[k]} BETWEEN {a} AND {b}, true)" for k, (a, b) in bounds.items() if k in typed)


def _laptop_sql() -> str:
    p = fixed.LAPTOP_CHIPS

    def chip(name: str) -> str:
        own = f"trim(concat_ws(' ', trim({name}), trim(\"processor variant\")))"
        brand = 'trim("processor brand")'
        return fold(f"trim(CASE WHEN {brand} <> '' AND NOT contains(lower({own}), lower({brand})) THEN concat_ws(' ', {brand}, {own}) ELSE {own} END)")

    said = [f"""CASE WHEN trim("{k}") <> '' THEN {chip(f'"{k}"')} END""" for k in ("processor name", "cpu_model", "chipset")]
    sku = p["core_i_sku"]
    chips = f"""coalesce({fold("trim(nullif(trim(cpu_model), ''))")}, {said[0]}, trim({group("t", p["apple"])}), trim({group("t", p["core_ultra"])}), {group(group("t", sku), "i[3579]", 0)} || '-' || {group("t", sku, 2)},
    CASE WHEN {group("t", p["core_i_tier"], 2)} IS NOT NULL THEN concat_ws(' ', {group("t", p["core_i_tier"], 2)}, {group("t", p["core_i_tier"], 3)}) END, {", ".join(f"trim({group('t', p[k])})" for k in ("ryzen_sku", "ryzen_tier", "mediatek", "intel_other", "snapdragon"))}, {said[1]}, {said[2]})"""
    gpu = rf"""coalesce(gpu_model, 'nvidia rtx ' || {group("t", r"\b(?:geforce\s+)?(?:rtx|gtx)\s*(\d{4}(?:\s*ti)?)\b")}, 'amd ' || {group("t", r"\b(radeon\s+rx\s*\d{4}[a-z]*)\b")}, trim({group("t", r"\b(intel\s+arc\s*[a-z0-9]*)\b")}),
    trim({fold("nullif(trim(graphics), '')")}), 'apple ' || {group("t", r"\b(m[1-5](?:\s+(?:pro|max|ultra))?)\b")} || ' gpu')"""
    tb = lambda c, q: f"{_int(group(c, q))} * 1024"
    storage = f"""coalesce({tb("t", r"\b([1-4])\s*tb\b")}, {_listed(r"\b(\d{2,4})\s*gb\b", fixed.LAPTOP_STORAGE_GB)}, {_first(["storage", "ssd capacity"], lambda c: f"coalesce({tb(fold(c), r'(\d+)\s*tb')}, {_int(group(fold(c), r'(\d+)\s*gb'))})")})"""
    inches = lambda x: _within(f"(CASE WHEN {x} > 25 THEN round({x} / 2.54, 1) ELSE {x} END)", 10.0, 20.0)
    screen = f"""coalesce({inches(_double(group("t", r'\b(\d{2}(?:\.\d{1,2})?)\s*(?:inch|inches|"|\s*-inch|\s*cm)\b')))}, {_first(["screen size"], lambda c: f"coalesce({_double(group(c, '(?i)(' + chr(92) + 'd{2}(?:' + chr(92) + '.' + chr(92) + 'd{1,2})?)' + chr(92) + 's*(?:inch|inches|' + chr(34) + ')'))}, {inches(_double(group(c, NUMBER)))})")})"""
    battery = f"""coalesce({_double(group("t", r"\b(\d{2,3}(?:\.\d)?)\s*wh\b"))}, {_within(_double(group("lower(battery)", r"(\d{2,3}(?:\.\d)?)\s*(?:wh|watt\s*hours)")), 10.0, 150.0)})"""
    kinds = [([k], k.upper()) for k in ("lpddr5x", "lpddr5", "ddr5", "lpddr4x", "ddr4")] + [(["unified memory"], "Unified Memory")]
    put = {
        "f_brand": _brand(fixed.LAPTOP_BRANDS, fixed.LAPTOP_ALIASES), "f_family": first_label("words", fixed.LAPTOP_FAMILIES), "f_chip": chips, "f_gpu": gpu,
        "f_ram": f"coalesce({_int('ram_gb')}, {_listed(r'\b(\d{1,2})\s*gb(?:\s+(?:ddr\d|lpddr\d|unified\s+memory|ram))?\b', fixed.LAPTOP_RAM_GB)}, {_int(group('lower(ram)', r'(\d+)\s*gb'))})",
        "f_storage": storage, "f_screen": screen, "f_generation": group("t", r"\b(\d{1,2}(?:th|nd|rd|st))\s+gen(?:eration)?\b"), "f_ram_type": f"""coalesce({first_words("t", kinds)}, upper("ram type"))""",
        "f_resolution": first_words("t", [(["4k", "uhd"], "4K UHD"), (["2.8k"], "2.8K"), (["2.5k", "qhd"], "2.5K QHD"), (["fhd", "1080p"], "FHD"), (["wuxga"], "WUXGA"), (["retina"], "Liquid Retina")]),
        "f_display": first_words("t", [(["liquid retina xdr"], "Liquid Retina XDR"), (["oled"], "OLED"), (["ips"], "IPS LCD")]), "f_vram": _int(group("t", r"\b([1-9]|1[26]|24)\s*gb\s*(?:graphics|vram|rtx|gtx)\b")),
        "f_weight": f"""coalesce({_double(group("t", r"\b([0-2]\.[0-9]{1,2})\s*kg\b"))}, {_first(["weight", "item weight"], _weight_kg)})""", "f_battery": battery, "f_backlit": "contains(t, 'backlit') OR contains(everything, 'backlit')",
    }
    b = fixed.LAPTOP_BOUNDS
    sound = _sound(b, {"ram_gb": "f_ram", "storage_gb": "f_storage", "screen_size_inches": "f_screen", "refresh_rate_hz": _int("refresh_rate_hz"), "gpu_vram_gb": "f_vram", "weight_kg": "f_weight", "battery_wh": "f_battery"})
    if_sound = lambda x, other="NULL": f"CASE WHEN sound THEN {x} ELSE {other} END"
    default = "coalesce(f_gpu, CASE WHEN regexp_matches(f_chip, '^m[1-5]') THEN 'apple ' || f_chip || ' gpu' WHEN f_chip IS NOT NULL THEN 'integrated graphics' END)"
    return f"""WITH {_rows_sql(LAPTOP_TITLE, LAPTOP_SPECS)}, f AS (SELECT *, {", ".join(f"{x} AS {k}" for k, x in put.items())} FROM w), g AS (SELECT *, {sound} AS sound FROM f)
SELECT p_partkey, {if_sound(norm("f_brand"), norm("said"))} AS brand, {if_sound("f_family")} AS family, {if_sound("f_generation")} AS generation, {if_sound(norm("f_chip"))} AS chip, {if_sound("f_ram")} AS ram_gb, {if_sound("f_storage")} AS storage_gb, {if_sound("'ssd'")} AS storage_type,
  {if_sound("f_screen")} AS screen_size_inches, {if_sound(norm(default))} AS gpu_model, {norm("mpn")} AS manufacturer_part_number, {norm("gtin")} AS gtin, {norm("CASE WHEN trim(name) <> '' AND length(name) <= 60 OR NOT sound THEN name END")} AS own_name, {if_sound("lower(f_ram_type)")} AS ram_type, {if_sound("lower(f_resolution)")} AS display_resolution,
  {if_sound("lower(f_display)")} AS display_type, {if_sound("f_vram")} AS gpu_vram_gb, {if_sound("f_weight")} AS weight_kg, {if_sound("f_battery")} AS battery_wh, {if_sound("CASE WHEN f_backlit THEN 'true' END")} AS keyboard_backlight, {norm('"processor brand"')} AS processor_brand FROM g"""


@query("laptop_fingerprint", _laptop_sql())
def laptop_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    r = _frame(spark, d, "laptop", LAPTOP_TITLE, LAPTOP_SPECS)
    a = lambda k, kind="string": F.try_element_at("fp.attributes", F.lit(k)).cast(kind).alias(k)
    own = (F.trim("model_name") != "") & (F.length("model_name") <= 60) | F.col("fp.family").isNull() & F.col("fp.storage_type").isNull()
    return r.select(
        "p_partkey", *[F.col(f"fp.{k}").alias(k) for k in ("brand", "family", "generation", "chip", "ram_gb", "storage_gb", "storage_type", "screen_size_inches", "gpu_model", "manufacturer_part_number", "gtin")], F.when(own, F.col("fp.model_name")).alias("own_name"),
        a("ram_type"), a("display_resolution"), a("display_type"), a("gpu_vram_gb", "int"), a("weight_kg", "double"), a("battery_wh", "double"), a("keyboard_backlight"), a("processor brand").alias("processor_brand"),
    )


MOBILE_TITLE = {
    "a": field("Apple", "Samsung", "OnePlus", "Redmi", "POCO", "realme", "vivo", "iQOO", "Google", "Moto", "Nothing", "CMF", "Tecno", "Somebody", None),
    "b": field("iPhone 15 Pro Max", "Galaxy S24 Ultra", "Galaxy A35", "Pixel 8 Pro", "OnePlus 12R", "Redmi Note 13 Pro+", "realme narzo 60 Pro", "Vivo X100 Pro", "moto g85", "Nothing Phone (2a)", "iPhone 15", "Poco X6 Pro", None, step=2),
    "c": field("5G", None, "4G", step=3), "d": field("A17 Pro Bionic", "Snapdragon 8 Gen 3", "Dimensity 9300", "Tensor G3", "Unisoc T612", "Snapdragon 695", None, None, step=4),
    "e": field("8GB RAM", "12 GB", "6 gb", "5GB", None, step=5), "f": field("128GB ROM", "256 GB Storage", "1TB", "1 TB", "500GB", None, step=6), "g": field("Natural Titanium", "Phantom Black", "Black", "Rose Gold", "Mint", None, step=7),
    "h": field("6.7 inch", "17.02 cm", "120Hz", "50MP", "200 MP Quad Camera", "5000mAh", "80W SUPERVOOC", "AMOLED", "Super Retina XDR", "OLED IP68", "FHD+ IPS", "Ceramic Shield", "QHD+ OIS", "Gorilla Glass Victus 2", "HD+ Triple Camera", "android 14", None, step=1, shift=3),
}
MOBILE_SPECS = {
    "processor": field("MediaTek Helio G85", None, None, step=4), "ram": field("4 GB", None, "none", step=3), "storage": field("64 GB", None, "1 TB", "lots", step=5), "screen size": field("6.5 inches", "17.14 cm", None, "6.1", "16.5", "900", step=6), "refresh rate": field("90 Hz", None, "fast", step=7),
    "camera": field("50MP + 8MP + 2MP", "48MP + 12MP", "Dual 13MP", None, "quad 64", "7MP", step=2), "primary camera": field(None, None, "108MP OIS", step=8), "battery capacity": field("4500 mAh", None, "450", step=9), "operating system": field("Android 13", None, " iOS 17", step=10),
    "resolution": field("2400 x 1080", "1600 x 720", None, "3120 x 1440", "640", step=3, shift=1), "water resistance": field("ip67 rated", None, "yes", None, step=4), "display protection": field("Gorilla Glass 5", "Victus", None, None, step=5), "color": field(None, None, None, None, "Own Colour", " ", step=6),
    "ram_gb": field(None, None, None, None, None, "16", "99", "x", step=7), "front_camera_mp": field(None, "32", None, "1", "sixteen", step=8), "weight_grams": field(None, None, "190.5", None, "20", step=9), "biometrics": field(None, "Face ID", step=10), "nfc_supported": field("true", None, "maybe", step=11), "network_type": field(None, None, None, None, "5G", step=12),
}
_MOBILE_INT = ["ram_gb", "storage_gb", "refresh_rate_hz", "primary_camera_mp", "front_camera_mp", "battery_mah", "fast_charging_w"]
_MOBILE_TEXT = ["chipset", "color", "network_type", "display_type", "operating_system", "resolution_standard", "camera_setup", "water_resistance_rating", "screen_protection", "ois_supported", "biometrics", "nfc_supported"]


def _mobile_sql() -> str:
    ip = r"\b(ip6[89]|ip6[57]|ip5[45]|ip53)\b"
    mp = r"(200|108|64|50|48|32|13|12|8|5)"
    ask = lambda q, c="t": _int(group(c, q))
    tb = lambda c: f"CASE WHEN contains({c}, '1tb') OR contains({c}, '1 tb') THEN 1024 END"
    cm = lambda c, q: _within(f"round({_double(group(c, q))} / 2.54, 2)", 1.5, 8.5)
    bare = r"^\s*(\d+(?:\.\d+)?)\s*$"
    inch = r'(?i)(\d+(?:\.\d+)?)\s*(?:in|inch|inches|"|″|-inch)'
    s = '"screen size"'
    screen = f"""coalesce({_double(group("t", r'([2-7](?:\.[0-9]{1,2})?)\s*(?:in|inch|inches|"|″|-inch)'))}, {cm("t", r"(\d{1,2}(?:\.\d{1,2})?)\s*cm")}, {_within(_double(group(s, inch)), 1.5, 8.5)}, {cm(s, r"(?i)(\d+(?:\.\d+)?)\s*cm")}, {_within(_double(group(s, bare)), 1.5, 8.5)},
    CASE WHEN {_double(group(s, bare))} > 8.5 THEN {cm(s, bare)} END)"""
    plus = "(length(camera) - length(replace(camera, '+', '')))"
    mentions = lambda x: f"(contains(t, '{x}') OR contains(everything, '{x}'))"
    colors = [(r"\b(?:" + c + r")\b", c.title()) for c in fixed.MOBILE_COLORS]
    any_ = lambda c, rules: cases([(f"({test})", f"'{x}'") for test, x in rules])
    read = {
        "ram_gb": f"coalesce({ask(r'\b([2468]|12|16|24)\s*gb(?:\s+ram)?\b')}, {ask(r'(\d+)\s*gb', 'lower(ram)')})", "storage_gb": f"coalesce({tb('t')}, {ask(r'\b(32|64|128|256|512)\s*gb(?:\s+(?:rom|storage))?\b')}, {tb('lower(storage)')}, {ask(r'(\d+)\s*gb', 'lower(storage)')})",
        "chipset": f"coalesce({', '.join(f'trim({group(chr(116), q)})' for q in fixed.MOBILE_CHIPS.values())}, trim({fold('processor')}))", "color": first_label("t", colors), "network_type": "CASE WHEN contains(t, '5g') THEN '5G' ELSE '4G' END", "screen_size_inches": screen,
        "display_type": f"CASE WHEN contains(t, 'super retina xdr') OR contains(everything, 'super retina') THEN 'Super Retina XDR' ELSE {first_words('t', [(['amoled'], 'AMOLED'), (['oled'], 'OLED'), (['ips'], 'IPS LCD'), (['hd+'], 'HD+ Display')])} END",
        "refresh_rate_hz": f"coalesce({ask(r'\b(60|90|120|144|165)\s*hz\b')}, {ask(r'\b(60|90|120|144|165)\b', chr(34) + 'refresh rate' + chr(34))})", "primary_camera_mp": f"coalesce({ask(rf'\b{mp}\s*mp\b')}, {ask(rf'\b{mp}\b', chr(34) + 'primary camera' + chr(34))}, {ask(rf'\b{mp}\b', 'camera')})",
        "battery_mah": f"coalesce({ask(r'\b([1-9][0-9]{3})\s*mah\b')}, {ask(r'\b([1-9][0-9]{3})\b', chr(34) + 'battery capacity' + chr(34))})", "fast_charging_w": ask(r"\b(\d{2,3})\s*w\s*(?:hypercharge|turbopower|fast|charging|supervooc)?\b"),
        "operating_system": f"""coalesce({first_words("t", [(["iphone", "apple"], "iOS"), (["android"], "Android")])}, trim("operating system"), 'Android')""",
        "resolution_standard": f"coalesce({first_words('t', [(['4k'], '4K UHD'), (['qhd+', '2k'], 'QHD+'), (['1.5k'], '1.5K'), (['fhd+', 'full hd+'], 'FHD+'), (['hd+'], 'HD+')])}, {first_words('resolution', [(['3840'], '4K UHD'), (['2560', '3120'], 'QHD+'), (['2400', '1080'], 'FHD+'), (['720'], 'HD+')])})",
        "camera_setup": f"coalesce({first_words('t', [(['quad camera'], 'Quad Camera'), (['triple camera'], 'Triple Camera'), (['dual camera'], 'Dual Camera')])}, {any_('', [(f'contains(lower(camera), {chr(39)}quad{chr(39)}) OR {plus} >= 3', 'Quad Camera'), (f'contains(lower(camera), {chr(39)}triple{chr(39)}) OR {plus} = 2', 'Triple Camera'), (f'contains(lower(camera), {chr(39)}dual{chr(39)}) OR {plus} = 1', 'Dual Camera')])})",
        "water_resistance_rating": f"upper(coalesce({group('t', ip)}, {group('lower(' + chr(34) + 'water resistance' + chr(34) + ')', ip)}))",
        "screen_protection": any_("", [("contains(t, 'ceramic shield') OR contains(t, 'iphone')", "Ceramic Shield"), (mentions("victus 2"), "Gorilla Glass Victus 2"), (mentions("victus"), "Gorilla Glass Victus"), (mentions("gorilla glass"), "Gorilla Glass")]), "ois_supported": f"CASE WHEN {mentions('ois')} THEN 'true' END",
        "front_camera_mp": "NULL", "weight_grams": "NULL", "biometrics": "NULL", "nfc_supported": "NULL",
    }
    given = {"ram_gb": _int("ram_gb"), "color": "CASE WHEN trim(color) <> '' THEN color END", "front_camera_mp": _int("front_camera_mp"), "weight_grams": _double("weight_grams"), "biometrics": "biometrics", "nfc_supported": "try_cast(nfc_supported AS BOOLEAN)::VARCHAR", "network_type": "network_type"}
    put = {f"f_{k}": f"coalesce({given[k]}, {x})" if k in given else x for k, x in read.items()} | {"f_brand": _brand(fixed.MOBILE_BRANDS, fixed.MOBILE_ALIASES), "f_family": first_label("words", fixed.MOBILE_FAMILIES)}
    sound = _sound(fixed.MOBILE_BOUNDS, {k: f"f_{k}" for k in read})
    if_sound = lambda x, other="NULL": f"CASE WHEN sound THEN {x} ELSE {other} END"
    own = {k: norm(f'"{k}"') for k in MOBILE_SPECS}  # what is given stays, where the numbers are out of bounds
    texts = ", ".join(f"{if_sound(norm(f'f_{k}'), own.get(k, 'NULL'))} AS {k}" for k in _MOBILE_TEXT)
    ints = ", ".join(f"{if_sound(f'f_{k}')} AS {k}" for k in _MOBILE_INT)
    return f"""WITH {_rows_sql(MOBILE_TITLE, MOBILE_SPECS)}, f AS (SELECT *, {", ".join(f"{x} AS {k}" for k, x in put.items())} FROM w), g AS (SELECT *, {sound} AS sound FROM f)
SELECT p_partkey, {if_sound(norm("f_brand"), norm("said"))} AS brand, {if_sound("f_family")} AS family, {if_sound(norm("f_chipset"))} AS chip, {if_sound("f_screen_size_inches")} AS screen_size_inches, {if_sound("f_weight_grams")} AS weight_grams, {norm("mpn")} AS manufacturer_part_number, {norm("gtin")} AS gtin, {ints}, {texts} FROM g"""


@query("mobile_fingerprint", _mobile_sql())
def mobile_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    r = _frame(spark, d, "mobile", MOBILE_TITLE, MOBILE_SPECS).withColumn("sound", F.map_contains_key("fp.attributes", "operating_system"))
    a = lambda k: F.try_element_at("fp.attributes", F.lit(k))
    return r.select(
        "p_partkey", *[F.col(f"fp.{k}").alias(k) for k in ("brand", "family", "chip", "screen_size_inches", "manufacturer_part_number", "gtin")], F.when(F.col("sound"), a("weight_grams").try_cast("double")).alias("weight_grams"),
        *[F.when(F.col("sound"), a(k).try_cast("int")).alias(k) for k in _MOBILE_INT], *[a(k).alias(k) for k in _MOBILE_TEXT],
    )
