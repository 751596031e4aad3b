"""Identity fingerprints of listings: free-text titles and specifications to typed attributes.

A category is a Category: how its listings are normalized, when two fingerprints can't be the same product, and how similar they are,
all as builders of Column expressions. Categories can be added with register_category.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import all_within, built, first_key, first_pattern, first_words, get, map_of, ordered, overlay, refold
from ..functions.text import any_word, cm_to_inch, collapse_repeats, count_of, first_of, fold, group, is_ignored_key, nonblank, text_norm, weight_kg, within

FINGERPRINT = "category string, brand string, family string, model_name string, generation string, chip string, ram_gb int, storage_gb int, storage_type string, screen_size_inches double, gpu_model string, manufacturer_part_number string, gtin string, attributes map<string,string>"
# This pattern and those within the functions below, which say how titles and specifications put each attribute.
NUMBER = r"(\d+(?:\.\d+)?)"


def _no_specs() -> Column:
    return F.create_map().cast("map<string,string>")


def _brand(title: Column, said: Column, brands: list[str], aliases: dict[str, str]) -> Column:
    s = fold(F.trim(said))
    s = ordered([(s == a, F.lit(b)) for a, b in aliases.items()], s)
    t = fold(title)
    word = nonblank(F.element_at(F.split(F.trim(t), r"\s+"), 1))
    return F.coalesce(F.when(s.isin(brands), s), first_pattern(t, [(any_word([a]), b) for a, b in aliases.items()]), first_pattern(t, [(any_word([b]), b) for b in brands]), word, F.lit("unknown"))


def _full_chip(specs: Column, name: Column) -> Column:
    """Brand, name and variant of a processor, in lower case."""
    own = F.trim(F.concat_ws(" ", F.trim(name), F.trim(get(specs, "processor variant"))))
    brand = F.trim(get(specs, "processor brand"))
    return fold(F.trim(F.when((brand != "") & ~F.lower(own).contains(F.lower(brand)), F.concat_ws(" ", brand, own)).otherwise(own)))


def laptop_chip(title: Column, specs: Column) -> Column:
    t, p = fold(title), fixed.LAPTOP_CHIPS
    sku, tier = p["core_i_sku"], p["core_i_tier"]
    names = ["processor name", "cpu model", "processor", "cpu_model", "processor type", "chipset"]
    return F.coalesce(
        fold(F.trim(nonblank(get(specs, "cpu_model")))), F.when(F.trim(get(specs, "processor name")) != "", _full_chip(specs, get(specs, "processor name"))),
        F.trim(group(t, p["apple"])), F.trim(group(t, p["core_ultra"])),
        F.concat(group(group(t, sku), r"i[3579]", 0), F.lit("-"), group(t, sku, 2)), _tier(t, tier),
        *[F.trim(group(t, p[k])) for k in ("ryzen_sku", "ryzen_tier", "mediatek", "intel_other", "snapdragon")],
        *[F.when(F.trim(get(specs, k)) != "", _full_chip(specs, get(specs, k))) for k in names],
    )


def _tier(t: Column, pattern: str) -> Column:
    return F.when(group(t, pattern, 2).isNotNull(), F.concat_ws(" ", group(t, pattern, 2), group(t, pattern, 3)))


def laptop_gpu(title: Column, specs: Column) -> Column:
    t = fold(title)
    keys = ["graphic processor", "graphics processor", "graphics", "gpu", "gpu model", "gpu_model"]
    return F.coalesce(
        F.concat(F.lit("nvidia rtx "), group(t, r"\b(?:geforce\s+)?(?:rtx|gtx)\s*(\d{4}(?:\s*ti)?)\b")),
        F.concat(F.lit("amd "), group(t, r"\b(radeon\s+rx\s*\d{4}[a-z]*)\b")), F.trim(group(t, r"\b(intel\s+arc\s*[a-z0-9]*)\b")),
        first_key(specs, keys, lambda c: F.trim(fold(nonblank(c)))),
        F.concat(F.lit("apple "), group(t, r"\b(m[1-5](?:\s+(?:pro|max|ultra))?)\b"), F.lit(" gpu")),
    )


def _whitelisted(t: Column, pattern: str, allowed: list[int]) -> Column:
    """The first number that the pattern finds and that is allowed."""
    return F.try_element_at(F.filter(F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), lambda x: x.cast("int")), lambda x: x.isin(allowed)), F.lit(1))


def laptop_ram(title: Column, specs: Column) -> Column:
    return F.coalesce(_whitelisted(fold(title), r"\b(\d{1,2})\s*gb(?:\s+(?:ddr\d|lpddr\d|unified\s+memory|ram))?\b", fixed.LAPTOP_RAM_GB), group(fold(get(specs, "ram")), r"(\d+)\s*gb").try_cast("int"))


def laptop_storage(title: Column, specs: Column) -> Column:
    t = fold(title)
    tb = lambda c, p: group(c, p).try_cast("int") * 1024
    keys = ["storage", "ssd capacity", "hdd capacity", "hard disk size", "storage capacity"]
    return F.coalesce(tb(t, r"\b([1-4])\s*tb\b"), _whitelisted(t, r"\b(\d{2,4})\s*gb\b", fixed.LAPTOP_STORAGE_GB), first_key(specs, keys, lambda c: F.coalesce(tb(fold(c), r"(\d+)\s*tb"), group(fold(c), r"(\d+)\s*gb").try_cast("int"))))


def _inches(number: Column) -> Column:
    """A laptop's diagonal; more than 25 must be cm."""
    return within(F.when(number > 25, cm_to_inch(number, 1)).otherwise(number), 10.0, 20.0)


def laptop_screen(title: Column, specs: Column) -> Column:
    keys = ["screen size", "display size", "display size (in inches)", "screen size (in inches)", "screen size (in cm)", "display size (in cms)", "screen dimensions"]
    said = lambda c: F.coalesce(group(c, r"(?i)(\d{2}(?:\.\d{1,2})?)\s*(?:inch|inches|\")").try_cast("double"), _inches(group(c, NUMBER).try_cast("double")))
    return F.coalesce(_inches(group(fold(title), r"\b(\d{2}(?:\.\d{1,2})?)\s*(?:inch|inches|\"|\s*-inch|\s*cm)\b").try_cast("double")), first_key(specs, keys, said))


def laptop_generation(title: Column) -> Column:
    return group(fold(title), r"\b(\d{1,2}(?:th|nd|rd|st))\s+gen(?:eration)?\b")


def laptop_ram_type(title: Column, specs: Column) -> Column:
    rules = [([t], t.upper()) for t in ("lpddr5x", "lpddr5", "ddr5", "lpddr4x", "ddr4")] + [(["unified memory"], "Unified Memory")]
    return F.coalesce(first_words(fold(title), rules), F.upper(get(specs, "ram type")))


def laptop_resolution(title: Column) -> Column:
    return first_words(fold(title), [(["4k", "uhd"], "4K UHD"), (["2.8k"], "2.8K"), (["2.5k", "qhd"], "2.5K QHD"), (["fhd", "1080p"], "FHD"), (["wuxga"], "WUXGA"), (["retina"], "Liquid Retina")])


def laptop_display(title: Column) -> Column:
    return first_words(fold(title), [(["liquid retina xdr"], "Liquid Retina XDR"), (["oled"], "OLED"), (["ips"], "IPS LCD")])


def laptop_vram(title: Column) -> Column:
    return group(fold(title), r"\b([1-9]|1[26]|24)\s*gb\s*(?:graphics|vram|rtx|gtx)\b").try_cast("int")


def laptop_weight(title: Column, specs: Column) -> Column:
    return F.coalesce(group(fold(title), r"\b([0-2]\.[0-9]{1,2})\s*kg\b").try_cast("double"), first_key(specs, ["weight", "item weight", "product weight", "package weight"], weight_kg))


def laptop_battery(title: Column, specs: Column) -> Column:
    said = lambda c: within(group(fold(c), r"(\d{2,3}(?:\.\d)?)\s*(?:wh|watt\s*hours)").try_cast("double"), 10.0, 150.0)
    return F.coalesce(group(fold(title), r"\b(\d{2,3}(?:\.\d)?)\s*wh\b").try_cast("double"), first_key(specs, ["battery cell", "battery", "battery capacity", "standard battery life", "lithium battery energy content"], said))


def _mentions(title: Column, specs: Column, word: str) -> Column:
    """Whether the title, or any key or value of the specifications, contains the word."""
    return fold(title).contains(word) | F.exists(F.map_entries(specs), lambda e: fold(e["key"]).contains(word) | fold(e["value"]).contains(word))


def _own_name(said: Column, title: Column, longest: int) -> Column:
    return F.when((F.trim(said) != "") & (said != title) & (F.length(said) <= longest), said)


def _normalized(f: dict[str, Column], attributes: Column) -> Column:
    """The fingerprint's struct, its texts folded and squeezed."""
    texts = ("brand", "family", "model_name", "generation", "chip", "storage_type", "gpu_model", "manufacturer_part_number", "gtin")
    kinds = dict(x.split(" ", 1) for x in FINGERPRINT.split(", "))
    folded = refold(attributes, lambda k: F.trim(fold(k)), text_norm)
    put = {k: text_norm(c) if k in texts else c for k, c in f.items()} | {"attributes": folded}
    return F.struct(*[put.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in kinds.items()])


LAPTOP_EXPLICIT = ["ram_gb", "storage_gb", "cpu_model", "gpu_model", "screen_size_inches", "generation", "ram_type", "display_resolution", "display_type", "gpu_vram_gb", "weight_kg", "battery_wh", "keyboard_backlight", "mpn", "gtin", "asin", "ean"]
MOBILE_EXPLICIT = ["ram_gb", "storage_gb", "chipset", "color", "network_type", "screen_size_inches", "display_type", "refresh_rate_hz", "primary_camera_mp", "front_camera_mp", "battery_mah", "fast_charging_w", "operating_system", "resolution_standard", "camera_setup", "water_resistance_rating", "screen_protection", "ois_supported", "biometrics", "audio_jack_3_5mm", "nfc_supported", "weight_grams", "sim_type", "model_number", "mpn", "gtin", "asin", "ean", "warranty"]


def _extra(specs: Column, explicit: list[str]) -> Column:
    return F.map_filter(specs, lambda k, _: ~is_ignored_key(k) & ~k.isin(explicit))


def _basic(category: Column, brand: Column, name: Column, mpn: Column, gtin: Column, specs: Column) -> Column:
    return _normalized({"category": category, "brand": brand, "model_name": name, "manufacturer_part_number": mpn, "gtin": gtin}, specs)


IN = ("title_", "brand_", "name_", "mpn_", "gtin_", "specs_")


def staged(df: DataFrame, *steps: Callable[[], dict[str, Column]], name: str | None = None) -> DataFrame:
    """df with each step's columns in turn, so that later steps refer to columns, not to the expressions behind them.

    name: the steps are always the same under this name, so their expressions are made once.
    """
    for k, step in enumerate(steps):
        df = df.withColumns(built(step, name, str(k)) if name else step())
    return df


def laptop_fingerprint(df: DataFrame) -> DataFrame:
    """df with the column fp_, from the columns named in IN."""
    title, brand, name, mpn, gtin, specs = (F.col(c) for c in IN)
    f = lambda k: F.col(f"f_{k}")

    def read() -> dict[str, Column]:
        return {
            "f_words": fold(F.concat_ws(" ", F.coalesce(name, F.lit("")), title)), "f_brand": _brand(title, brand, fixed.LAPTOP_BRANDS, fixed.LAPTOP_ALIASES),
            "f_chip": laptop_chip(title, specs), "f_screen_size_inches": laptop_screen(title, specs),
            "f_ram_gb": F.coalesce(get(specs, "ram_gb").try_cast("int"), laptop_ram(title, specs)), "f_storage_gb": F.coalesce(get(specs, "storage_gb").try_cast("int"), laptop_storage(title, specs)),
            "f_gpu": F.coalesce(get(specs, "gpu_model"), laptop_gpu(title, specs)), "f_generation": laptop_generation(title), "f_ram_type": laptop_ram_type(title, specs),
            "f_display_resolution": laptop_resolution(title), "f_display_type": laptop_display(title), "f_gpu_vram_gb": laptop_vram(title), "f_weight_kg": laptop_weight(title, specs),
            "f_battery_wh": laptop_battery(title, specs), "f_keyboard_backlight": F.when(_mentions(title, specs, "backlit"), F.lit(True)), "f_extra": _extra(specs, LAPTOP_EXPLICIT),
        }

    def combine() -> dict[str, Column]:
        chip = f("chip")
        default = F.when(chip.rlike("^m[1-5]"), F.concat(F.lit("apple "), chip, F.lit(" gpu"))).when(chip.isNotNull(), F.lit("integrated graphics"))
        return {"f_family": first_pattern(f("words"), fixed.LAPTOP_FAMILIES), "f_gpu_model": F.coalesce(f("gpu"), default)}

    def call() -> dict[str, Column]:
        ram, storage = f("ram_gb"), f("storage_gb")
        built = F.concat_ws(
            " ", F.when(f("family").startswith(f("brand")), f("family")).otherwise(F.concat_ws(" ", f("brand"), f("family"))), F.concat(f("screen_size_inches").cast("string"), F.lit(" inch")), f("chip"),
            F.when(f("gpu").contains("nvidia"), f("gpu")), F.when((ram > 0) & (storage > 0), F.concat(ram, F.lit("gb / "), storage, F.lit("gb"))),
        )
        typed = {k: f(k) for k in LAPTOP_EXPLICIT if k not in ("cpu_model", "mpn", "gtin", "asin", "ean")} | {"cpu_model": f("chip"), "mpn": mpn, "gtin": gtin}
        sound = all_within(typed | {"refresh_rate_hz": get(specs, "refresh_rate_hz").try_cast("int")}, fixed.LAPTOP_BOUNDS)
        return {"f_model": collapse_repeats(F.coalesce(_own_name(name, title, 60), built)), "f_typed": map_of(typed), "f_sound": sound}

    def whole() -> dict[str, Column]:
        attributes = overlay(map_of({"storage_type": F.lit("ssd")}), f("extra"), f("typed"))
        full = _normalized(
            {"category": F.lit("laptop"), "model_name": f("model"), "storage_type": F.lit("ssd"), "manufacturer_part_number": mpn, "gtin": gtin}
            | {k: f(k) for k in ("brand", "family", "generation", "chip", "ram_gb", "storage_gb", "screen_size_inches", "gpu_model")}, attributes,
        )
        return {"fp_": F.when(f("sound"), full).otherwise(_basic(F.lit("laptop"), brand, name, mpn, gtin, specs))}

    return staged(df, read, combine, call, whole, name="laptop_fingerprint")


def mobile_screen(title: Column, specs: Column) -> Column:
    keys = ["screen size in inches", "screen size (in inches)", "display size (in inches)", "screen size", "display size", "screen size in cm", "display size in cm"]
    cm = lambda c, p: within(cm_to_inch(group(c, p).try_cast("double"), 2), 1.5, 8.5)
    bare = r"^\s*(\d+(?:\.\d+)?)\s*$"
    said = lambda c: F.coalesce(within(group(c, r"(?i)(\d+(?:\.\d+)?)\s*(?:in|inch|inches|\"|″|-inch)").try_cast("double"), 1.5, 8.5), cm(c, r"(?i)(\d+(?:\.\d+)?)\s*cm"), within(group(c, bare).try_cast("double"), 1.5, 8.5), F.when(group(c, bare).try_cast("double") > 8.5, cm(c, bare)))
    t = fold(title)
    return F.coalesce(group(t, r"([2-7](?:\.[0-9]{1,2})?)\s*(?:in|inch|inches|\"|″|-inch)").try_cast("double"), cm(t, r"(\d{1,2}(?:\.\d{1,2})?)\s*cm"), first_key(specs, keys, said))


def mobile_chip(title: Column, specs: Column) -> Column:
    t = fold(title)
    return F.coalesce(*[F.trim(group(t, p)) for p in fixed.MOBILE_CHIPS.values()], F.trim(fold(get(specs, "processor"))))


def mobile_color(title: Column) -> Column:
    return first_pattern(fold(title), [(any_word([c]), c.title()) for c in fixed.MOBILE_COLORS])


def mobile_storage(title: Column, specs: Column) -> Column:
    one_tb = lambda c: F.when(c.contains("1tb") | c.contains("1 tb"), F.lit(1024))
    t, s = fold(title), fold(get(specs, "storage"))
    return F.coalesce(one_tb(t), group(t, r"\b(32|64|128|256|512)\s*gb(?:\s+(?:rom|storage))?\b").try_cast("int"), one_tb(s), group(s, r"(\d+)\s*gb").try_cast("int"))


def mobile_typed(title: Column, specs: Column) -> dict[str, Column]:
    """What a phone's title and specifications say, by attribute; attributes given as such win."""
    t = fold(title)
    number = lambda p, c=t: group(c, p).try_cast("int")
    ip = r"\b(ip6[89]|ip6[57]|ip5[45]|ip53)\b"
    mp = r"(200|108|64|50|48|32|13|12|8|5)"
    camera = fold(get(specs, "camera"))
    plus = count_of(camera, "+")
    resolution = fold(get(specs, "resolution"))
    given = lambda k, kind="string": (nonblank(get(specs, k)) if kind == "string" else get(specs, k).try_cast(kind))
    read = {
        "ram_gb": F.coalesce(number(r"\b([2468]|12|16|24)\s*gb(?:\s+ram)?\b"), number(r"(\d+)\s*gb", fold(get(specs, "ram")))),
        "storage_gb": mobile_storage(title, specs),
        "chipset": mobile_chip(title, specs),
        "color": mobile_color(title),
        "network_type": F.when(t.contains("5g"), F.lit("5G")).otherwise(F.lit("4G")),
        "screen_size_inches": mobile_screen(title, specs),
        "display_type": F.when(t.contains("super retina xdr") | F.exists(F.map_entries(specs), lambda e: fold(e["key"]).contains("super retina") | fold(e["value"]).contains("super retina")), F.lit("Super Retina XDR")).otherwise(first_words(t, [(["amoled"], "AMOLED"), (["oled"], "OLED"), (["ips"], "IPS LCD"), (["hd+"], "HD+ Display")])),
        "refresh_rate_hz": F.coalesce(number(r"\b(60|90|120|144|165)\s*hz\b"), number(r"\b(60|90|120|144|165)\b", get(specs, "refresh rate"))),
        "primary_camera_mp": F.coalesce(number(rf"\b{mp}\s*mp\b"), first_key(specs, ["primary camera", "rear camera", "camera"], lambda c: number(rf"\b{mp}\b", c))),
        "battery_mah": F.coalesce(number(r"\b([1-9][0-9]{3})\s*mah\b"), number(r"\b([1-9][0-9]{3})\b", get(specs, "battery capacity"))),
        "fast_charging_w": number(r"\b(\d{2,3})\s*w\s*(?:hypercharge|turbopower|fast|charging|supervooc)?\b"),
        "operating_system": F.coalesce(first_words(t, [(["iphone", "apple"], "iOS"), (["android"], "Android")]), F.trim(get(specs, "operating system")), F.lit("Android")),
        "resolution_standard": F.coalesce(first_words(t, [(["4k"], "4K UHD"), (["qhd+", "2k"], "QHD+"), (["1.5k"], "1.5K"), (["fhd+", "full hd+"], "FHD+"), (["hd+"], "HD+")]), first_words(resolution, [(["3840"], "4K UHD"), (["2560", "3120"], "QHD+"), (["2400", "1080"], "FHD+"), (["720"], "HD+")])),
        "camera_setup": F.coalesce(first_words(t, [(["quad camera"], "Quad Camera"), (["triple camera"], "Triple Camera"), (["dual camera"], "Dual Camera")]), ordered([(camera.contains("quad") | (plus >= 3), F.lit("Quad Camera")), (camera.contains("triple") | (plus == 2), F.lit("Triple Camera")), (camera.contains("dual") | (plus == 1), F.lit("Dual Camera"))])),
        "water_resistance_rating": F.upper(F.coalesce(group(t, ip), group(fold(get(specs, "water resistance")), ip))),
        "screen_protection": ordered([(t.contains("ceramic shield") | t.contains("iphone"), F.lit("Ceramic Shield")), (_mentions(title, specs, "victus 2"), F.lit("Gorilla Glass Victus 2")), (_mentions(title, specs, "victus"), F.lit("Gorilla Glass Victus")), (_mentions(title, specs, "gorilla glass"), F.lit("Gorilla Glass"))]),
        "ois_supported": F.when(_mentions(title, specs, "ois"), F.lit(True)),
    }
    kinds = {"ram_gb": "int", "storage_gb": "int", "screen_size_inches": "double", "refresh_rate_hz": "int", "primary_camera_mp": "int", "battery_mah": "int", "fast_charging_w": "int", "ois_supported": "boolean"}
    out = {k: F.coalesce(given(k, kinds.get(k, "string")), c) for k, c in read.items()}
    out["water_resistance_rating"] = F.upper(out["water_resistance_rating"])
    only_given = {"front_camera_mp": "int", "weight_grams": "double", "biometrics": "string", "audio_jack_3_5mm": "boolean", "nfc_supported": "boolean", "sim_type": "string", "model_number": "string", "asin": "string", "warranty": "string"}
    return out | {k: given(k, kind) for k, kind in only_given.items()}


def mobile_fingerprint(df: DataFrame) -> DataFrame:
    """df with the column fp_, from the columns named in IN."""
    title, brand, name, mpn, gtin, specs = (F.col(c) for c in IN)
    f = lambda k: F.col(f"f_{k}")

    def read() -> dict[str, Column]:
        own = {f"f_{k}": c for k, c in mobile_typed(title, specs).items()}
        return own | {"f_words": fold(F.concat_ws(" ", F.coalesce(name, F.lit("")), title)), "f_brand": _brand(title, brand, fixed.MOBILE_BRANDS, fixed.MOBILE_ALIASES), "f_extra": _extra(specs, MOBILE_EXPLICIT), "f_short": F.trim(F.element_at(F.split(title, r"(?i)\(|\d+\s*gb|\||:"), 1))}

    def combine() -> dict[str, Column]:
        without = lambda c, head: F.when(F.lower(c).startswith(head), F.trim(F.substring(c, F.length(f("brand")) + 1, F.length(c)))).otherwise(c)
        return {"f_family": first_pattern(f("words"), fixed.MOBILE_FAMILIES), "f_short": without(f("short"), F.concat(f("brand"), F.lit(" ")))}

    def call() -> dict[str, Column]:
        ram, storage, short = f("ram_gb"), f("storage_gb"), f("short")
        rest = F.when(f("family").startswith(f("brand")), F.trim(F.substring(f("family"), F.length(f("brand")) + 1, F.length(f("family"))))).otherwise(f("family"))
        called = F.coalesce(F.initcap(rest), F.initcap(_own_name(name, title, 30)), F.when((short != "") & (F.length(short) <= 35), F.initcap(short)))
        gb = lambda c: F.concat(c, F.lit("GB"))
        sizes = ordered([((ram > 0) & (storage > 0), F.concat(F.lit("("), gb(ram), F.lit(" / "), gb(storage), F.lit(")"))), (storage > 0, F.concat(F.lit("("), gb(storage), F.lit(")")))])
        typed = {k: f(k) for k in MOBILE_EXPLICIT if k not in ("mpn", "gtin", "ean")}
        numbers = {"mpn": first_of(mpn, get(specs, "mpn")), "gtin": first_of(gtin, get(specs, "gtin"))}
        sound = all_within(typed | {"peak_brightness_nits": get(specs, "peak_brightness_nits").try_cast("int")}, fixed.MOBILE_BOUNDS)
        return {"f_model": collapse_repeats(F.concat_ws(" ", F.initcap(f("brand")), nonblank(called), sizes, nonblank(f("color")))), "f_typed": map_of(typed | numbers), "f_sound": sound}

    def whole() -> dict[str, Column]:
        full = _normalized(
            {"category": F.lit("mobile"), "model_name": f("model"), "chip": f("chipset"), "manufacturer_part_number": mpn, "gtin": gtin}
            | {k: f(k) for k in ("brand", "family", "ram_gb", "storage_gb", "screen_size_inches")}, overlay(f("extra"), f("typed")),
        )
        return {"fp_": F.when(f("sound"), full).otherwise(_basic(F.lit("mobile"), brand, name, mpn, gtin, specs))}

    return staged(df, read, combine, call, whole, name="mobile_fingerprint")


Pair = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Category:
    """fingerprint: a frame with the columns named in IN to one with fp_ as well; conflict (a reason or null) and similarity: of two fingerprints."""

    code: str
    fingerprint: Callable[[DataFrame], DataFrame]
    conflict: Pair | None = None
    similarity: Pair | None = None
    identity: tuple[str, ...] = ()


_CATEGORIES: dict[str, Category] = {}


def register_category(category: Category) -> None:
    _CATEGORIES[category.code.strip().lower()] = category


def categories() -> dict[str, Category]:
    return dict(_CATEGORIES)


def category(code: str) -> Category:
    try:
        return _CATEGORIES[code.strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported category: {code!r}") from None


def plain_fingerprint(df: DataFrame) -> DataFrame:
    """Brand, name, numbers and attributes as they are."""
    return df.withColumns(built(lambda: {"fp_": _basic(F.col("code_"), *(F.col(c) for c in IN[1:]))}, "plain_fingerprint"))


def with_fingerprint(listings: DataFrame, name: str = "fp") -> DataFrame:
    """listings with their fingerprint, by category; categories without a normalizer get the plain one.

    Each category's rows go through its own steps, so a table kept by category is read once for each.
    """
    c = lambda x, kind="string": F.col(x).cast(kind) if x in listings.columns else F.lit(None).cast(kind)
    given = (F.coalesce(c("title"), F.lit("")), c("brand"), c("model_name"), c("manufacturer_part_number"), c("gtin"), F.coalesce(c("attributes", "map<string,string>"), _no_specs()))
    rows = listings.withColumns(dict(zip(IN, given, strict=True)) | {"code_": F.coalesce(fold(F.trim(F.col("category"))), F.lit(""))})
    parts = [x.fingerprint(rows.filter(F.col("code_") == code)) for code, x in _CATEGORIES.items()] + [plain_fingerprint(rows.filter(~F.col("code_").isin(list(_CATEGORIES))))]
    out = None
    for p in parts:
        p = p.select(*[F.col(f"`{k}`") for k in listings.columns if k != name], F.col("fp_").alias(name))
        out = p if out is None else out.unionByName(p)
    return out
