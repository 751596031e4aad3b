"""Queries of typed attributes with their SQL: every field of laptops and phones, over titles and specifications made of part's keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.spread import spread
from ..operators import attributes as A
from .queries import query, table
from .sample import Field, cases, columns, field, first_label, first_words, fold, group, selects

LAPTOP_TITLE = {
    "a": field("Apple MacBook Pro", "HP 15", "Lenovo LOQ", "Dell", "Acer Aspire", None), "b": field("M3 Max chip", "Intel Core i5-1335U", "AMD Ryzen 7-7840HS", "Snapdragon X Elite", "MediaTek MT8183", "Intel Core Ultra i7", None, None, step=2),
    "c": field("16GB RAM", "8 GB LPDDR5", "32GB DDR5", None, step=3), "d": field("512GB SSD", "1TB NVMe", "64 GB eMMC", "1 TB HDD", None, step=5), "e": field("15.6 inch", '14.0"', None, step=7), "f": field("NVIDIA GeForce RTX 4060 Ti", "Intel Iris Xe", "Intel Arc A350M", None, None, step=4), "g": field("backlit", None, None, step=6),
}
LAPTOP_SPECS = {
    "ram": field("16 GB", None, "n/a", "0 GB", step=3), "memory": field("8 GB DDR4", None, "1.5 TB", step=4), "ssd capacity": field("512 GB", None, None, step=5), "hard drive size": field("1 TB", "1.5 GB", None, step=6), "emmc capacity": field(None, None, "128gb", step=7), "hdd capacity": field(None, None, None, "2 TB", step=8),
    "hard disk description": field("NVMe", "Mechanical Hard Disk", "eMMC 5.1", None, "1 TB", step=3, shift=1), "storage type": field("HDD", None, step=2), "graphics": field("Intel UHD", None, step=9), "graphics coprocessor": field(None, None, " RTX 3050 ", step=5), "ram type": field("lpddr5x", "DDR4 SDRAM", "Unified", "sdram", None, step=4),
    "operating system": field("Windows 11 ", None, step=3), "os": field("Chrome OS", None, step=4), "colour": field(" Silver", None, step=5), "color": field("Blue", None, step=2, shift=1), "display type": field("OLED panel", "ips", "LED backlit", "TN", None, step=3), "web camera": field("1080p FHD", "720p", "none", None, step=5), "camera": field("HD camera", None, step=7),
    "weight": field("1 kg 880 g", "1.65 Kg", "0.2 kg", None, step=4), "item weight": field("2 kg", None, step=3), "battery": field("42 Wh", "200 Wh", None, step=6), "battery cell": field("56.5 Watt Hours", "3 cell", None, step=5), "wireless lan": field("Wi-Fi 6E", "802.11ax", "wifi 5", "LAN", None, step=7), "wi-fi generation": field("Wi-Fi 7", None, step=3),
    "screen resolution": field("1920 x 1200", "2880 x 1800", "Full HD", "3840x2160", "unknown", None, step=4), "display resolution": field("2560 x 1440", None, step=5), "manufacturer part number": field(" AB12 ", None, step=6), "part number": field("ZZ9", None, step=5), "model number": field("X1", None, step=4), "model name": field("Y2", None, step=3), "asin": field("B0ABC", None, step=7),
    "warranty": field("1 Year ", None, step=5), "warranty description": field(None, None, "2 Years", step=3), "processor name": field("Core  i5", "Ryzen 5 Processor", None, None, step=3, shift=2), "processor type": field("Apple M2", None, step=8), "processor variant": field("1335U", None, step=4), "processor brand": field("Intel", None, "AMD", "", step=5),
    "processor": field("Celeron", None, step=6), "screen size": field("39.62 cm", "15.6 Inches", "5", None, "35.56", step=5), "display size": field("14", None, step=4), "backlit keyboard": field("Yes", "no", "maybe", None, None, step=6), "keyboard": field("Backlit RGB", "plain", None, step=7),
    "customer support number": field("1800 111 222", step=1),
}
MOBILE_TITLE = {
    "a": field("Apple iPhone 15", "Samsung Galaxy S24", "vivo", "Nothing", None), "b": field("8GB RAM", "6 GB", "12 gb", None, step=2), "c": field("128 GB Storage", "1 TB", "256GB ROM", None, step=3), "d": field("5G", None, step=4), "e": field("Phantom Black", "Natural Titanium", "Gold", None, step=5),
    "f": field("Snapdragon 8 Gen 3", "Dimensity 7200", "A17 Pro chip", "Helio G99", None, None, step=3, shift=1), "g": field("6.7 inch", "17.02 cm", '6.1"', None, step=6), "h": field("120Hz AMOLED", "OLED", "50 MP", "5000 mAh", "80W SUPERVOOC", "IP68", "OIS", "Ceramic Shield", "Victus 2", "victus", None, step=2, shift=1),
}
MOBILE_SPECS = {
    "ram": field("8 GB", None, "n/a", step=3), "system memory": field("12 GB", None, step=4), "internal storage": field("256 GB", None, step=5), "capacity": field("1 TB", None, "x", step=6), "colour": field("Mint", None, step=7), "network type": field("4G VOLTE", "5G", "3G", None, step=3), "display type": field("Super AMOLED", "AMOLED", "IPS", "E-ink", "LCD", None, step=4),
    "refresh rate": field("120 Hz", "75 Hz", None, step=5), "primary camera": field("50MP + 8MP", "108 Mega Pixel", "64 main", "3MP", None, step=6), "secondary camera": field("32MP", "16", "2MP", None, step=7), "camera features": field("OIS, EIS", "none", None, step=3), "battery capacity": field("5000 mAh", "4500", "200 mah", "99999", None, step=4),
    "quick charging": field("67W", "fast", None, step=5), "os type": field("Android 14", None, step=6), "resolution": field("2400 x 1080", "1600 x 720", "3120 x 1440", "2772 x 1220", "odd", None, step=3, shift=1), "camera setup": field("Triple", "quad", "dual", "one", None, step=7), "ip rating": field("IP68 rated", "none", None, step=5), "screen protection": field(" Gorilla Glass 5 ", None, step=4),
    "fingerprint sensor": field("In-Display", "Side-mounted", "fingerprint", "no", None, step=6), "sensors": field("Face ID", None, step=3), "sim type": field("Dual Sim", None, step=5), "weight": field("190 g", "1.2 kg", "20 g", None, step=4), "model number": field("SM-1", None, step=3), "asin": field("B0XYZ", None, step=2), "ean": field("890", None, step=6), "gtin": field("891", None, step=7),
    "warranty summary": field("1 Year", None, step=5), "audio jack": field("3.5 mm", "No", "Type-C", "odd", None, step=4), "headphone jack": field("Yes", None, step=3), "processor brand": field("Qualcomm", "NA", None, step=3, shift=2), "processor name": field("Snapdragon 695", "Octa-Core processor 2.2 GHz", "not available", "Helio G85,", None, step=4), "processor": field("Unisoc T612", "null", None, step=5),
    "screen size": field("17.14 cm (6.75 inch)", "6.5", "16.5", "6.1 in", "99 cm", None, step=5, shift=1),
}


def _frame(spark: SparkSession, d: str, code: str, title: dict[str, Field], specs: dict[str, Field]) -> DataFrame:
    p = spread(table(spark, d, "part").select("p_partkey"), "p_partkey").withColumns(columns(title))
    odd = lambda k: F.when(F.col("p_partkey") % 2 == 1, F.lit(k.upper() + " ")).otherwise(F.lit(k))
    entries = [F.when(f.spark("p_partkey").isNotNull(), F.struct(odd(k).alias("key"), f.spark("p_partkey").alias("value"))) for k, f in specs.items()]
    return A.with_attributes(p.select("p_partkey", F.lit(code).alias("category"), F.concat_ws(" ", *title).alias("title"), F.map_from_entries(F.array_compact(F.array(*entries))).alias("specs")))


def _rows_sql(title: dict[str, Field], specs: dict[str, Field]) -> str:
    return f"r0 AS (SELECT p_partkey, {selects(title)}, {selects(specs)} FROM part), r AS (SELECT *, concat_ws(' ', {', '.join(title)}) AS title FROM r0), w AS (SELECT *, {fold('title')} AS t FROM r)"


def _q(k: str) -> str:
    return f'"{k}"'


def _within(x: str, low: float, high: float) -> str:
    return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN {x} END"


def _double(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


def _int(x: str) -> str:
    return f"try_cast({x} AS INT)"


def _capacity(c: str) -> str:
    p = r"(?i)^\s*(\d+(?:\.\d+)?)\s*(tb|gb)\s*$"
    amount = f"(try_cast({group(c, p)} AS DECIMAL(18,6)) * CASE WHEN lower({group(c, p, 2)}) = 'tb' THEN 1024 ELSE 1 END)"
    return f"CASE WHEN {amount} > 0 AND {amount} = floor({amount}) THEN {amount}::BIGINT END"


def _first_capacity(c: str) -> str:
    return _capacity(f"coalesce({group(c, r'(?i)\d+(?:\.\d+)?\s*(?:tb|gb)', 0)}, {c})")


def _words(rules: A.Words):  # noqa: ANN202
    return lambda c: first_words(f"lower({c})", rules)


def _number(pattern: str, low: float, high: float):  # noqa: ANN202
    return lambda c: _within(_double(group(f"lower({c})", pattern)), low, high)


def _largest(pattern: str, bare: str, low: int, high: int):  # noqa: ANN202
    def sql(c: str) -> str:
        marked, others = (f"regexp_extract_all(lower({c}), '{p}', 1)" for p in (pattern, bare))
        return f"list_max(list_filter(list_transform(CASE WHEN len({marked}) > 0 THEN {marked} ELSE {others} END, lambda x: x::INT), lambda x: x BETWEEN {low} AND {high}))"

    return sql


def _weight_kg(c: str) -> str:
    both = r"(\d+)\s*kg\s*(\d+)\s*g"
    split = f"round({_double(group(f'lower({c})', both))} + {_double(group(f'lower({c})', both, 2))} / 1000, 2)"
    plain = _double(group(f"lower({c})", r"(\d+(?:\.\d+)?)\s*kg"))
    return f"coalesce({_within(split, 0.5, 10.0)}, {_within(plain, 0.5, 10.0)})"


def _by_key(rules: dict, specs: dict[str, Field], parse: dict) -> dict[str, str]:
    """The first of a field's keys, in the rules' order, whose value parses."""
    out = {}
    for k, (keys, _) in rules.items():
        own = [parse.get(k, lambda c: f"trim({c})")(_q(x)) for x in keys if x in specs]
        out[k] = f"coalesce({', '.join(own)}, NULL)" if own else "NULL"
    return out


def _squeezed(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


def _select(fields: dict[str, str], specs: dict[str, Field]) -> str:
    """Typed values as texts; where one is missing, what the specification of that name says."""
    given = lambda k: _q(k) if k in specs else "NULL"
    return ", ".join(f"coalesce(({x})::VARCHAR, trim({given(k)})) AS {k}" for k, x in fields.items())


def _laptop_sql() -> str:
    s = LAPTOP_SPECS
    f = _by_key(A.LAPTOP_RULES, s, {
        "ram_gb": _first_capacity, "storage_gb": _first_capacity, "storage_type": _words(A.DRIVES), "ram_type": lambda c: f"coalesce({_words(A.RAM_TYPES)(c)}, upper(trim({c})))", "display_type": _words(A.LAPTOP_PANELS), "webcam_resolution": _words(A.WEBCAMS),
        "weight_kg": _weight_kg, "battery_wh": _number(r"(\d{2,3}(?:\.\d)?)\s*(?:wh|watt\s*hours)", 10.0, 150.0), "wifi_standard": _words(A.WIFI), "display_resolution": _words(A.LAPTOP_RESOLUTIONS),
    })
    cap = lambda what: _capacity(group("title", rf"(?i)(\d+\s*(?:GB|TB))\s+(?:{what})"))
    has = lambda k: f"{_q(k)} IS NOT NULL"
    own = """trim(concat_ws(' ', coalesce(nullif("processor name", ''), nullif("processor type", '')), "processor variant"))"""
    own = f"""(CASE WHEN "processor brand" <> '' AND NOT contains(lower({own}), lower("processor brand")) THEN concat_ws(' ', "processor brand", {own}) ELSE {own} END)"""
    apple = "(contains(t, 'macbook') OR contains(t, 'apple'))"
    m = group("title", A.APPLE_M)
    title_cpu = f"trim(regexp_replace({group('title', A.LAPTOP_TITLE_CPU)}, '(?i)\\s+chip$', ''))"
    plain = """trim(processor), trim("processor variant"), trim("processor brand")"""
    size = lambda c: _double(group(c, r"(\d{1,2}(?:\.\d{1,2})?)"))
    screen = lambda c: _within(f"(CASE WHEN {size(c)} > 24 THEN round({size(c)} / 2.54, 1) ELSE {size(c)} END)", 9.0, 24.0)
    said = 'lower("backlit keyboard")'
    f |= {
        "ram_gb": f"coalesce({f['ram_gb']}, {cap('RAM|DDR|LPDDR|Memory')})", "storage_gb": f"coalesce({f['storage_gb']}, {cap('SSD|HDD|ROM|NVMe|Storage|EMMC')})",
        "storage_type": f"coalesce({f['storage_type']}, {cases([(has('ssd capacity') + ' OR contains(t, ' + chr(39) + 'ssd' + chr(39) + ')', chr(39) + 'SSD' + chr(39)), ('contains(t, ' + chr(39) + 'emmc' + chr(39) + ') OR ' + has('emmc capacity'), chr(39) + 'eMMC' + chr(39)), ('contains(t, ' + chr(39) + 'hdd' + chr(39) + ') OR ' + has('hdd capacity'), chr(39) + 'HDD' + chr(39))])})",
        "cpu_model": f"""CASE WHEN {has("processor name")} OR {has("processor type")} THEN coalesce({_squeezed(f"regexp_replace({own}, '(?i)" + chr(92) + "bprocessor" + chr(92) + "b', '', 'g')")}, '') ELSE coalesce({plain}, {title_cpu}, CASE WHEN {apple} THEN 'Apple ' || {m} END) END""",
        "gpu_model": f"coalesce({f['gpu_model']}, {group('title', A.LAPTOP_TITLE_GPU)}, CASE WHEN {apple} THEN 'Apple ' || {m} || ' GPU' END)",
        "screen_size_inches": f"""coalesce({screen(_q("screen size"))}, {screen(_q("display size"))}, {_double(group("title", r'(?i)(\d{2}(?:\.\d{1,2})?)\s*(?:inch|inches|"|-inch)'))})""",
        "keyboard_backlight": f"CASE WHEN {said} IN ('yes', 'true', '1') THEN 'True' WHEN {said} IN ('no', 'false', '0') THEN 'False' WHEN {said} IS NULL AND (contains(t, 'backlit') OR contains(lower(coalesce(keyboard, '')), 'backlit')) THEN 'True' END",
    }
    return f"""WITH {_rows_sql(LAPTOP_TITLE, s)} SELECT p_partkey, {_select(f, s)}, trim("processor brand") AS processor_brand, NULL::VARCHAR AS ignored FROM w"""


@query("laptop_attributes", _laptop_sql())
def laptop_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Every typed field; a specification that means something stays, one of contacts goes."""
    r, a = _frame(spark, d, "laptop", LAPTOP_TITLE, LAPTOP_SPECS), lambda k: F.try_element_at("attributes", F.lit(k))
    fields = [*A.LAPTOP_RULES, "cpu_model", "screen_size_inches", "keyboard_backlight"]
    return r.select("p_partkey", *[a(k).alias(k) for k in fields], a("processor brand").alias("processor_brand"), a("customer support number").alias("ignored"))


def _mobile_sql() -> str:
    s = MOBILE_SPECS
    mp = r"\b(\d{1,3})\s*(?:mp|megapixel|mega pixel)\b"
    f = _by_key(A.MOBILE_RULES, s, {
        "ram_gb": _first_capacity, "storage_gb": _first_capacity, "network_type": _words([(["5g"], "5G"), (["4g", "lte"], "4G")]), "display_type": _words(A.MOBILE_PANELS), "refresh_rate_hz": lambda c: _int(group(c, r"\b(60|90|120|144|165)\b")),
        "primary_camera_mp": _largest(mp, r"\b(200|108|64|50|48|32|13|12|8|5)\b", 5, 200), "front_camera_mp": _largest(mp, r"\b(50|32|20|16|13|12|8|5)\b", 4, 64),
        "battery_mah": lambda c: _within(f"(coalesce({_int(group(f'lower({c})', r'(\d{3,5})\s*mah'))}, {_int(group(c, r'\b([1-9][0-9]{3})\b'))}))", 500, 15000), "fast_charging_w": lambda c: _int(group(f"lower({c})", r"(\d{2,3})\s*w")), "resolution_standard": _words(A.MOBILE_RESOLUTIONS),
        "camera_setup": _words(A.CAMERA_SETUPS), "ois_supported": lambda c: f"CASE WHEN contains(lower({c}), 'ois') OR contains(lower({c}), 'optical image') THEN 'true' END", "water_resistance_rating": lambda c: f"upper({group(f'lower({c})', A.IP)})", "biometrics": _words(A.BIOMETRICS), "weight_grams": _number(r"(\d+(?:\.\d+)?)\s*g", 50.0, 600.0),
    })
    some = lambda c: f"CASE WHEN lower(trim({c})) NOT IN ('not available', 'na', 'null', 'none') AND trim({c}) <> '' THEN trim({c}) END"
    brand, name = some('"processor brand"'), """coalesce(nullif("processor name", ''), nullif(processor, ''))"""
    name = f"coalesce({some(name)}, CASE WHEN lower(trim({name})) IN ('not available', 'na', 'null', 'none') THEN {some('processor')} END)"
    chip = f"(CASE WHEN n.b IS NOT NULL AND NOT contains(lower(n.c), lower(n.b)) THEN concat_ws(' ', n.b, n.c) ELSE n.c END)"
    chip = rf"regexp_replace({chip}, '(?i)\b(?:processor|octa-core|octa core|quad-core|quad core|dual-core|dual core|[\d.]+\s*ghz)\b', '', 'g')"
    chip = some(_squeezed(rf"regexp_replace(trim({chip}), ',\s*$', '')"))
    bionic = f"trim(regexp_replace({group('t', r'\b(a1[4-9](?:\s+pro)?(?:\s+bionic)?(?:\s+chip)?)\b')}, '\\s+chip$', ''))"
    capital = f"array_to_string(list_transform(string_split({bionic}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
    ask = lambda p: _int(group("t", p))
    cm = lambda c, p: _within(f"round({_double(group(f'lower({c})', p))} / 2.54, 2)", 1.5, 8.5)
    inch, bare, z = r'(\d+(?:\.\d+)?)\s*(?:in|inch|inches|"|″|-inch)', r"^\s*(\d+(?:\.\d+)?)\s*$", _q("screen size")
    screen = f"coalesce({_number(inch, 1.5, 8.5)(z)}, {cm(z, r'(\d+(?:\.\d+)?)\s*cm')}, {_number(bare, 1.5, 8.5)(z)}, CASE WHEN {_double(group(z, bare))} > 8.5 THEN {cm(z, bare)} END)"
    jack = lambda k: first_words(f"lower({_q(k)})", [(["3.5", "yes"], "True"), (["no", "type-c", "usb"], "False")])
    f |= {
        "ram_gb": f"coalesce({f['ram_gb']}, {ask(r'\b([23468]|12|16|24)\s*gb(?:\s+ram)?\b')})", "storage_gb": f"coalesce({f['storage_gb']}, CASE WHEN contains(t, '1tb') OR contains(t, '1 tb') THEN 1024 END, {ask(r'\b(32|64|128|256|512)\s*gb(?:\s+(?:rom|storage|internal\s+storage))?\b')})",
        "chipset": f"coalesce({chip}, nullif({capital}, ''), {group('title', A.MOBILE_TITLE_CHIP)})", "color": f"coalesce({f['color']}, {first_label('t', [(chr(92) + 'b' + c + chr(92) + 'b', c.title()) for c in fixed.MOBILE_COLORS])})",
        "network_type": f"coalesce({f['network_type']}, CASE WHEN contains(t, '5g') THEN '5G' ELSE '4G' END)", "screen_size_inches": f"""coalesce({screen}, {_double(group("t", r'([2-7](?:\.[0-9]{1,2})?)\s*(?:in|inch|inches|"|″|-inch)'))}, {cm("title", r"(\d{1,2}(?:\.\d{1,2})?)\s*cm")})""",
        "display_type": f"coalesce({f['display_type']}, {first_words('t', [(['super retina', 'xdr'], 'Super Retina XDR'), (['amoled'], 'AMOLED'), (['oled'], 'OLED')])})", "refresh_rate_hz": f"coalesce({f['refresh_rate_hz']}, {ask(r'\b(60|90|120|144|165)\s*hz\b')})",
        "primary_camera_mp": f"coalesce({f['primary_camera_mp']}, {ask(r'\b(200|108|64|50|48|32|13|12|8|5)\s*mp\b')})", "battery_mah": f"coalesce({f['battery_mah']}, {ask(r'\b([1-9][0-9]{3})\s*mah\b')})", "fast_charging_w": f"coalesce({f['fast_charging_w']}, {ask(r'\b(\d{2,3})\s*w\s*(?:charging|fast|supervooc|hypercharge|turbopower|dart)?\b')})",
        "operating_system": f"coalesce({f['operating_system']}, CASE WHEN contains(t, 'iphone') OR contains(t, 'apple') OR contains(t, 'ios') THEN 'iOS' ELSE 'Android' END)", "ois_supported": f"CASE WHEN {f['ois_supported']} IS NOT NULL OR contains(t, 'ois') THEN 'True' END",
        "water_resistance_rating": f"coalesce({f['water_resistance_rating']}, upper({group('t', A.IP)}))", "screen_protection": f"coalesce({f['screen_protection']}, {first_words('t', [(['ceramic shield', 'iphone'], 'Ceramic Shield'), (['victus 2'], 'Gorilla Glass Victus 2'), (['victus'], 'Gorilla Glass Victus')])})",
        "audio_jack_3_5mm": f"CASE WHEN {_q('audio jack')} IS NOT NULL THEN {jack('audio jack')} WHEN {_q('headphone jack')} IS NOT NULL THEN {jack('headphone jack')} END",
    }
    f |= {"model_number": f["mpn"], "ean": f["gtin"]}
    return f"WITH {_rows_sql(MOBILE_TITLE, s)}, x AS (SELECT *, {{'b': {brand}, 'c': {name}}} AS n FROM w) SELECT p_partkey, {_select(f, s)} FROM x"


@query("mobile_attributes", _mobile_sql())
def mobile_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Every typed field of phones."""
    r, a = _frame(spark, d, "mobile", MOBILE_TITLE, MOBILE_SPECS), lambda k: F.try_element_at("attributes", F.lit(k))
    fields = [*A.MOBILE_RULES, "chipset", "screen_size_inches", "audio_jack_3_5mm", "model_number", "ean"]
    return r.select("p_partkey", *[a(k).alias(k) for k in fields])
