"""Rules over text, periods, evidence and land as Spark columns. Nulls give null unless a function says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fold

# Numbers, bands, text


def plain_number(text: Column) -> Column:
    """A number whose lone comma is a decimal one; a dot is decimal too, so both together are no number."""
    bare = F.replace(F.trim(text), F.lit(" "), F.lit(""))
    lone = (F.size(F.split(bare, ",")) == 2) & ~F.contains(bare, F.lit("."))
    return F.when(lone, F.replace(bare, F.lit(","), F.lit("."))).otherwise(bare).try_cast("double")


def local_number(text: Column) -> Column:
    """A number in Turkish notation among other signs: dots part thousands where a comma or whole groups of three say so."""
    bare = F.regexp_replace(text, "[^0-9.,-]", "")
    both = F.contains(bare, F.lit(",")) & F.contains(bare, F.lit("."))
    plain = (
        F.when(both, F.regexp_replace(F.replace(bare, F.lit("."), F.lit("")), "^([^,]*),", "$1."))
        .when(F.contains(bare, F.lit(",")), F.regexp_replace(bare, "^([^,]*),", "$1."))
        .when(bare.rlike(r"^-?[0-9]{1,3}([.][0-9]{3})+$"), F.replace(bare, F.lit("."), F.lit("")))
        .otherwise(bare)
    )
    return F.regexp_extract(plain, r"^(-?[0-9]*[.]?[0-9]*)", 1).try_cast("double")


def band_bounds(text: Column) -> Column:
    """(low, high) of an area band: '1-1.000', '100.001 ve üzeri'; high is null where the band is open or names one number."""
    bare = F.replace(F.trim(text), F.lit("."), F.lit(""))
    numbers = F.transform(F.regexp_extract_all(bare, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("long"))
    open_end = F.lower(bare).rlike("üzeri|uzeri") | (F.size(numbers) == 1)
    return F.when((bare != "0") & (F.size(numbers) > 0), F.struct(F.element_at(numbers, 1).alias("low"), F.when(~open_end, F.try_element_at(numbers, F.lit(2))).alias("high")))


def turkish_lower(text: Column) -> Column:
    return F.lower(F.translate(text, "İI", "iı"))


def turkish_title(text: Column) -> Column:
    """Each word begins with a capital letter by Turkish rules: i becomes İ, ı becomes I."""

    def word(w: Column) -> Column:
        return F.concat(F.upper(F.translate(F.left(w, F.lit(1)), "iı", "İI")), turkish_lower(F.substring(w, F.lit(2), F.length(w))))

    return F.array_join(F.transform(F.split(F.trim(text), r"\s+"), word), " ")


def place_name(text: Column) -> Column:
    """A place's folded name without parentheses and the words that only say what kind of place it is."""
    bare = fold(F.regexp_replace(text, r"\([^)]*\)", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"\b(mahallesi|mah|ilcesi|ili|koyu|belediyesi)\b", " "), " +", " "))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whether a folded phrase stands in a folded text as words, the last with a suffix of four letters at most."""
    return F.rlike(fold(text), F.concat(F.lit("(^| )"), phrase, F.lit("[a-z]{0,4}( |$)")))


def row_hash(*columns: Column) -> Column:
    """SHA-256 of a row: values parted by a unit separator, nulls told from empty texts."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)), 256)


def shard(key: Column, n: int) -> Column:
    """One of n shards, by the first 32 bits of the key's SHA-256."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long") % n


def canonical_url(url: Column) -> Column:
    """A URL without its fragment, tracking parameters and last slash, the other parameters sorted by name."""
    bare = F.regexp_replace(url, "#.*$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.rlike(x, F.lit("(?i)^(utm_|ref(=|$)|source(=|$)|tracking)")))
    name = lambda x: F.split_part(x, F.lit("="), F.lit(1))
    placed = F.array_sort(F.transform(kept, lambda x, i: F.struct(name(x).alias("name"), i.alias("i"), x.alias("x"))))
    params = F.array_join(F.transform(placed, lambda s: s["x"]), "&")
    return F.regexp_replace(F.concat(F.regexp_replace(bare, r"\?.*$", ""), F.when(params != "", F.concat(F.lit("?"), params)).otherwise("")), "/$", "")


# Periods


def period_place(period: Column) -> Column:
    """(year, month) of a period that begins with a year: month 0 for whole years, a quarter's last month; null for other months."""
    year = F.regexp_extract(period, r"^\s*(\d{4})", 1).try_cast("int")
    month = F.regexp_extract(period, r"^\s*\d{4}-(\d{1,2})", 1).try_cast("int")
    quarter = F.regexp_extract(period, r"(?i)^\s*\d{4}[- ]?Q([1-4])", 1).try_cast("int")
    found = F.coalesce(month, 3 * quarter, F.lit(0))
    return F.when(year.isNotNull() & (month.isNull() | month.between(1, 12)), F.struct(year.alias("year"), found.alias("month")))


def is_future(period: Column, reference: Column) -> Column:
    """Whether a period lies after the reference time's month; a whole year only if it is a later one. False where either can't be read."""
    a, b = period_place(period), period_place(reference)
    later = F.when(a["month"] == 0, a["year"] > b["year"]).otherwise((a["year"] > b["year"]) | ((a["year"] == b["year"]) & (a["month"] > b["month"])))
    return F.coalesce(F.when(b["month"] > 0, later), F.lit(False))


def period_number(period: Column) -> Column:
    """Months, quarters or years since year 0, by the period's form: 2024-07, 2024-Q3, 2024."""
    return (
        F.when(period.rlike(r"^\d{4}$"), period.try_cast("long"))
        .when(period.rlike(r"^\d{4}-Q[1-4]$"), F.substring(period, 1, 4).try_cast("long") * 4 + F.substring(period, 7, 1).try_cast("long") - 1)
        .when(period.rlike(r"^\d{4}-\d{2}"), F.substring(period, 1, 4).try_cast("long") * 12 + F.substring(period, 6, 2).try_cast("long") - 1)
    )


def numbered_period(number: Column, kind: Column) -> Column:
    """The period of a number; kind: month, quarter or year."""
    part = lambda n: F.floor(number / n).cast("long")
    return (
        F.when(kind == "year", number.cast("string"))
        .when(kind == "quarter", F.concat(part(4).cast("string"), F.lit("-Q"), (F.pmod(number, F.lit(4)) + 1).cast("string")))
        .otherwise(F.concat(part(12).cast("string"), F.lit("-"), F.lpad((F.pmod(number, F.lit(12)) + 1).cast("string"), 2, "0")))
    )


def clock(seconds: Column) -> Column:
    """HH:MM of seconds since midnight, which may pass a day."""
    minutes = F.floor(F.pmod(seconds, F.lit(86400)) / 60)
    return F.concat(F.lpad(F.floor(minutes / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"))


def recency(date: Column, today: Column) -> Column:
    """1 today, falling to 0.2 over two years; 0.35 without a date."""
    days = F.greatest(F.datediff(today, date), F.lit(0))
    return F.when(date.isNull(), 0.35).otherwise(F.greatest(F.lit(0.2), 1 - days / 730))


# Evidence


def noisy_or(*evidence: Column) -> Column:
    """1 less the product of what each evidence leaves open; nulls are no evidence."""
    left = F.lit(1.0)
    for e in evidence:
        left = left * (1 - F.coalesce(e, F.lit(0.0)))
    return 1 - left


def name_evidence(similarity: Column, most: Column | float = 0.90) -> Column:
    return most * F.greatest(F.lit(0.0), (similarity - 0.80) / 0.20)


def geometry_score(name: Column, iou: Column, inside: Column, same: Column, digits: int = 4) -> Column:
    """How sure two places are one, by name, overlap of areas (null without a geometry), a centre inside, and a common district."""
    score = noisy_or(name_evidence(name, F.when(same, 0.90).otherwise(0.60)), F.when(inside, 0.80), F.when(iou >= 0.20, F.least(F.lit(0.985), iou)))
    score = F.when((iou < 0.20) & ~inside & (name >= 0.95), score * 0.60).otherwise(score)
    score = F.when(iou.isNull(), F.least(score, F.lit(0.94))).otherwise(score)
    return F.round(F.when((name < 0.70) & (score >= 0.95), F.least(score, F.lit(0.985))).otherwise(score), digits)


def population_score(name: Column, consistency: Column, digits: int = 4) -> Column:
    """Likewise by name and by how well populations agree, 0 to 1 or null."""
    score = noisy_or(name_evidence(name), 0.85 * consistency)
    return F.round(F.when((consistency == 0) & (name >= 0.95), score * 0.70).otherwise(score), digits)


def match_band(score: Column) -> Column:
    return F.when(score >= 0.995, "exact").when(score >= 0.980, "very_high").when(score >= 0.950, "high").when(score >= 0.850, "review_recommended").otherwise("no_auto_merge")


def record_quality(kind: Column, natural_key: Column, parsed: Column, has_period: Column) -> Column:
    """0 to 100 by the record's class, less 25 without a natural key and 20 where parsing failed, 5 more with a period."""
    points = F.create_map(*(F.lit(x) for pair in (("observed", 70), ("projection", 40), ("observed_unresolved_projection_flag", 35), ("demo", 10), ("quarantine", 0), ("invalid", 0)) for x in pair))
    score = F.coalesce(F.try_element_at(points, kind), F.lit(50)) - F.when(natural_key, 0).otherwise(25) - F.when(parsed, 0).otherwise(20) + F.when(has_period, 5).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score))


# Land


def flood_proxy(stream_m: Column, lake_m: Column, above_m: Column) -> Column:
    """A class of flood risk by the nearest stream and lake and the height above the ground around; no official one."""
    middle = ((stream_m <= 400) & (above_m <= 6)) | (lake_m <= 300)
    return F.when(stream_m.isNull(), "far").when((stream_m <= 150) & (above_m <= 3), "high").when(middle, "middle").otherwise("low")


def slide_proxy(mean_slope: Column, most_slope: Column, weak: Column) -> Column:
    """A class of landslide risk by slopes around, in percent, and whether the ground is of a weak kind; no official one."""
    return F.when(mean_slope.isNull(), "unknown").when((mean_slope >= 25) | ((most_slope >= 40) & weak), "high").when((mean_slope >= 15) | (most_slope >= 30), "middle").otherwise("low")


def slope_aspect(z: Column, step_m: Column) -> Column:
    """(slope in percent, compass azimuth of the descent) of nine heights, north-west first, by Horn's kernel; null without them."""
    at = lambda i: F.element_at(z, i)
    east = ((at(3) + 2 * at(6) + at(9)) - (at(1) + 2 * at(4) + at(7))) / (8 * step_m)
    north = ((at(1) + 2 * at(2) + at(3)) - (at(7) + 2 * at(8) + at(9))) / (8 * step_m)
    return F.when(F.size(z) == 9, F.struct((100 * F.sqrt(east * east + north * north)).alias("slope"), F.pmod(F.degrees(F.atan2(-east, -north)) + 360, F.lit(360.0)).alias("aspect")))


def ring_measures(x: Column, y: Column) -> Column:
    """(area, perimeter, compactness) of a closed ring of metres, whose last point is its first, by the shoelace formula."""
    n = F.size(x)
    i = F.sequence(F.lit(1), n - 1)
    total = lambda f: F.aggregate(F.transform(i, f), F.lit(0.0), lambda acc, v: acc + v)
    twice = total(lambda k: F.element_at(x, k) * F.element_at(y, k + 1) - F.element_at(x, k + 1) * F.element_at(y, k))
    length = total(lambda k: F.sqrt(F.pow(F.element_at(x, k + 1) - F.element_at(x, k), 2) + F.pow(F.element_at(y, k + 1) - F.element_at(y, k), 2)))
    area = F.abs(twice) / 2
    return F.struct(area.alias("area"), length.alias("perimeter"), F.when(length > 0, 4 * F.pi() * area / (length * length)).alias("compactness"))
