"""Scalar functions as Column expressions: parsing, cleaning, classing and naming. No Python runs a row."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category names and ids.
CATEGORY_IDS = {
    "Mass": 1,
    "Calcification": 2,
    "Asymmetry": 3,
    "Focal Asymmetry": 4,
    "Global Asymmetry": 5,
    "Architectural Distortion": 6,
    "Suspicious Lymph Node": 7,
    "Skin Thickening": 8,
    "Skin Retraction": 9,
    "Nipple Retraction": 10,
}
# Upper bounds of area percentages and their labels.
SIZE_BINS = ((0.05, "tiny (<0.05%)"), (0.10, "very_small (0.05-0.10%)"), (0.50, "small (0.10-0.50%)"), (1.00, "medium (0.50-1.00%)"))
LARGEST_BIN = "large (>=1.00%)"
# Texts that mean a missing value, and those that mean true.
MISSING = ("", "nan", "none", "null")
TRUE_WORDS = ("1", "true", "yes", "on")


def first_int(c: Column) -> Column:
    """The first run of digits in a text."""
    return F.regexp_extract(c, "([0-9]+)", 1).try_cast("int")


def density_code(c: Column) -> Column:
    """Letters A to D as whole words, in this precedence, as 0 to 3."""
    upper = F.upper(c)
    out = F.lit(None).cast("int")
    for code, letter in reversed(list(enumerate("ABCD"))):
        out = F.when(upper.rlike(rf"\b{letter}\b"), F.lit(code)).otherwise(out)
    return out


def parse_list(c: Column) -> Column:
    """A list literal, JSON array or comma list as array<string>, trimmed, without empties."""
    listed = F.from_json(c, "array<string>", {"mode": "PERMISSIVE"})
    plain = F.transform(F.split(F.regexp_replace(c, r"^\s*\[|\]\s*$", ""), ","), lambda x: F.regexp_replace(F.trim(x), r"^['\"]|['\"]$", ""))
    return F.filter(F.coalesce(listed, plain), lambda x: F.trim(x) != "")


def category_ids(names: Column, ids: dict[str, int] = CATEGORY_IDS) -> Column:
    """Ids of the known names, in order; unknown names drop."""
    table = F.create_map(*[F.lit(v) for pair in ids.items() for v in pair])
    return F.filter(F.transform(names, lambda n: F.try_element_at(table, F.trim(n))), lambda i: i.isNotNull())


def has_category(names: Column, wanted: str, exact: bool = False) -> Column:
    """Whether a list holds a name, by default without regard to case and blanks."""
    return F.exists(names, lambda n: n == wanted) if exact else F.exists(names, lambda n: F.lower(F.trim(n)) == wanted.lower())


def parse_box(c: Column) -> Column:
    """array<double> of four finite numbers with positive area from a JSON array, else null."""
    box = F.from_json(c, "array<double>", {"mode": "PERMISSIVE"})
    finite = F.forall(box, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when((F.size(box) == 4) & finite & (F.get(box, 2) > F.get(box, 0)) & (F.get(box, 3) > F.get(box, 1)), box)


def clean_text(c: Column) -> Column:
    """Trimmed text, null for words that mean missing."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*MISSING), t)


def clean_bool(c: Column) -> Column:
    """True for the true words, null for missing, else false."""
    return F.when(clean_text(c).isNotNull(), F.lower(F.trim(c)).isin(*TRUE_WORDS))


def clean_int(c: Column) -> Column:
    return F.trim(c).try_cast("double").try_cast("int")


def finite(c: Column) -> Column:
    """The number, null for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def shape_group(aspect: Column) -> Column:
    a = finite(aspect)
    return F.when(a > 1.33, "wide").when(a < 0.75, "tall").when(a.isNotNull(), "square_like")


def size_bin(percent: Column) -> Column:
    a = finite(percent)
    out = F.when(a.isNotNull(), F.lit(LARGEST_BIN))
    for bound, label in reversed(SIZE_BINS):
        out = F.when(a < bound, label).otherwise(out)
    return out


def box_size_class(area: Column) -> Column:
    """small, medium or large by the square root of the area."""
    side = F.sqrt(area)
    return F.when(side < 32, "small").when(side < 96, "medium").otherwise("large")


def opposite_side(c: Column) -> Column:
    first = F.left(F.upper(F.trim(c)), F.lit(1))
    return F.when(first == "L", "R").when(first == "R", "L")


def round_up(c: Column, divisor: int) -> Column:
    return (F.floor((c + (divisor - 1)) / divisor) * divisor).cast("long")


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5).cast("long")


def wanted_negatives(positives: Column, ratio: float) -> Column:
    """Negatives for a share ``ratio`` of positives, rounded half to even."""
    if ratio >= 1:
        return F.lit(0).cast("long")
    return F.when(positives > 0, F.bround(positives * (1.0 - ratio) / ratio)).otherwise(0).cast("long")


def format_bytes(c: Column, precision: int = 1) -> Column:
    """Binary units, the sign kept; whole bytes half to even."""
    units = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")
    size, sign = F.abs(c.cast("double")), F.when(c < 0, "-").otherwise("")
    out = F.format_string(f"%.{precision}f {units[-1]}", size / 1024.0**6)
    for k in range(len(units) - 2, 0, -1):
        out = F.when(size < 1024.0 ** (k + 1), F.format_string(f"%.{precision}f {units[k]}", size / 1024.0**k)).otherwise(out)
    out = F.when(size < 1024.0, F.concat(F.bround(size).cast("long").cast("string"), F.lit(" B"))).otherwise(out)
    return F.concat(sign, out)


def path_stem(c: Column) -> Column:
    """Last part of a path of either slash, without its extension."""
    return F.regexp_replace(F.regexp_extract(F.replace(c, F.lit("\\"), F.lit("/")), "([^/]+)/*$", 1), r"(.)\.[^.]+$", "$1")


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_")


def vendor_label(maker: Column, model: Column) -> Column:
    label = F.concat_ws(" / ", clean_text(maker), clean_text(model))
    return F.when(label != "", label).otherwise("Unknown")


def seeded_order(seed: int | str, *keys: Column) -> Column:
    """A reproducible order: hex digest of the seed and the keys, the same in every SQL engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))


def cadence(ratio: float) -> tuple[int, int]:
    """(positives, negatives) of the shortest repeating schedule that has the share of positives."""
    part = Fraction(min(1.0, max(0.01, ratio))).limit_denominator(10_000)
    p, q = part.numerator, part.denominator - part.numerator
    if not p or not q:
        return (1, 0) if p else (0, 1)
    return (-(-p // q), 1) if p >= q else (1, -(-q // p))


def ordered_rank(c: Column, order: list[str]) -> Column:
    """Place of a value in an ordered list; unknown values are null."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), c), F.lit(0).cast("long"))


# Names of a selection mode as users write them.
SELECTION_MODES = {
    "all": ("all", "all_windows"),
    "mass_only": ("mass_only", "positive_only", "mass only"),
    "positive_ratio": ("positive_ratio", "all_mass_plus_sampled_non_mass", "all mass + sampled non-mass"),
    "crop_label_ratio": ("crop_label_ratio", "crop mass/empty ratio", "mass crops + negative-image empty crops", "positive_ratio_negative_images_only"),
    "negative_fraction": ("negative_fraction", "negative fraction", "all_positive_plus_negative_fraction", "all positive + fraction of negatives"),
    "source_breast_ratio": ("source_breast_ratio", "source breast ratio", "breast_status_ratio", "mass/negative breasts"),
    "finding_images_all_windows": (
        "finding_images_all_windows",
        "finding_images_only_all_windows",
        "findings_images_all_windows",
        "finding images, all windows",
        "finding images only, all windows",
        "images with findings, all windows",
        "positive images, all windows",
    ),
}


def selection_mode(c: Column, include_empty: Column | bool = True) -> Column:
    """The mode that a text means; for other texts all or mass_only, by whether empty windows are wanted."""
    plain = F.lower(F.trim(c))
    known = F.coalesce(*[F.when(plain.isin(*names), F.lit(mode)) for mode, names in SELECTION_MODES.items()])
    return F.coalesce(known, F.when(F.lit(include_empty) if isinstance(include_empty, bool) else include_empty, "all").otherwise("mass_only"))


def parse_sizes(c: Column) -> Column:
    """array<struct<width, height>> of a list such as '1024, 640x512'; null if a part is no size, none is there or one is repeated."""
    parts = F.filter(F.transform(F.split(c, "[,;\n]+"), lambda p: F.trim(p)), lambda p: p != "")
    form = r"^(\d+)(?:\s*[xX]\s*(\d+))?$"

    def size(p: Column) -> Column:
        w, h = F.regexp_extract(p, form, 1), F.regexp_extract(p, form, 2)
        return F.struct(w.try_cast("int").alias("width"), F.when(h == "", w).otherwise(h).try_cast("int").alias("height"))

    sizes = F.transform(parts, size)
    good = (F.size(parts) > 0) & F.forall(parts, lambda p: p.rlike(form)) & (F.size(F.array_distinct(sizes)) == F.size(sizes))
    return F.when(good, sizes)


def passes(fraction: Column, threshold: float, comparison: str = "greater_than_or_equal") -> Column:
    """A threshold that is inclusive or strict, by the names of both."""
    mode = comparison.strip().casefold()
    if mode in ("strictly_greater_than", "greater_than", ">", "strict"):
        return fraction > threshold
    if mode in ("greater_than_or_equal", "greater_than_or_equal_to", ">=", "inclusive"):
        return fraction >= threshold
    raise ValueError(f"unknown comparison {comparison}")


def positive_or(first: Column, other: Column) -> Column:
    """The first number if it is positive, else the other."""
    return F.coalesce(F.when(first > 0, first), other).cast("long")


def patch_grid(width: Column, height: Column, patch: int, registers: int) -> tuple[Column, Column, Column]:
    """(columns, rows, tokens) of a model input cut into square patches; one class token and the registers come first."""
    w, h = (F.floor(F.greatest(F.lit(patch), c) / patch).cast("long") for c in (width, height))
    return w, h, w * h + (1 + registers)
