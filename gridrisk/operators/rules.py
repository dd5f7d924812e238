"""Rules of the risk workflow: which exposure goes with which hazard, statistics tables, price ladders, season repair, disputed areas, threshold tables, labels, cash flows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridrisk.functions.scalars import col, safe_ratio
from gridrisk.operators.economics import avoided_loss
from gridrisk.operators.grid import with_rings

#: Exposure variables that only crops, and only livestock have.
CROP_ONLY, LIVESTOCK_ONLY, GENERIC = ("ha",), ("n", "head_n"), "generic-crop"
#: Rows that a lookup list (crops, parts, animals) may have where it's set against every row of a table.
LISTED = 10_000


def listed(df: DataFrame, *columns: str) -> Column:
    """The distinct rows of a lookup list as an array to explode, read once; more than LISTED of them are an error."""
    kind = df.select(*columns).schema
    rows = sorted((tuple(r) for r in df.select(*columns).distinct().limit(LISTED + 1).collect()), key=str)
    if len(rows) > LISTED:
        raise ValueError(f"a list of {', '.join(columns)} has more than {LISTED} rows")
    each = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, kind.fields, strict=True))) for r in rows]
    return F.array(*each) if each else F.array().cast(f"array<{kind.simpleString()}>")


# --------------------------------------------------------------------------- exposure
def selected_exposure(freq: DataFrame, exposure: DataFrame, kinds: DataFrame, digits: int | None = None) -> DataFrame:
    """at_risk of the pairs that make sense.

    freq: cell, commodity, p. exposure: cell, commodity, variable, value. kinds: commodity, kind (crop or livestock).
    Livestock has no harvested area and crops no heads: such pairs are left out. A commodity without exposure, and an exposed one without a kind, is an
    error, found by a job of its own before the plan is returned. The generic crop goes against every crop, and against their sum under its own name.
    """
    bare = exposure.select("commodity").distinct().join(kinds, "commodity", "left_anti").limit(5).collect()
    if bare:
        raise ValueError("no kind of " + ", ".join(sorted(str(r[0]) for r in bare)))
    crops = exposure.join(kinds, "commodity").where((F.col("kind") != "crop") | ~F.col("variable").isin(*LIVESTOCK_ONLY)).where((F.col("kind") != "livestock") | ~F.col("variable").isin(*CROP_ONLY))
    named, generic = freq.where(F.col("commodity") != GENERIC), freq.where(F.col("commodity") == GENERIC).select("cell", "p")
    unknown = named.select("commodity").distinct().join(exposure.select("commodity").distinct(), "commodity", "left_anti").limit(5).collect()
    if unknown:
        raise ValueError("no exposure of " + ", ".join(sorted(r[0] for r in unknown)))
    own = crops.where("kind = 'crop'").select("cell", "commodity", "variable", "value")
    whole = own.groupBy("cell", "variable").agg(F.sum("value").alias("value")).withColumn("commodity", F.lit(GENERIC))
    rows = named.join(crops.drop("kind"), ["cell", "commodity"]).unionByName(generic.join(own.unionByName(whole), "cell"))
    risk = F.col("p") * F.col("value")
    return rows.withColumn("at_risk", risk if digits is None else F.round(risk, digits))


def national_statistics(df: DataFrame, items: DataFrame, areas: DataFrame, element: str, units: list[str], first: int, last: int) -> DataFrame:
    """iso3, crop, year, value of one element in the units, for every country and crop of the lookups and every year: null where nothing is reported.

    df: area, item, element, unit, year, value. items: item, crop. areas: area, iso3. Several items of a crop add up.
    """
    own = df.where((F.col("element") == element) & F.col("unit").isin(*units) & F.col("year").between(first, last))
    known = own.join(items, "item").join(areas, "area").groupBy("iso3", "crop", "year").agg(F.sum("value").alias("value"))
    keys = areas.select("iso3").distinct().select("iso3", F.inline(listed(items, "crop")))
    return keys.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last)))).join(known, ["iso3", "crop", "year"], "left")


def price_ladder(df: DataFrame, places: DataFrame, edges: DataFrame, recent: tuple[int, int], keep_global: list[str] = (), floors: dict[str, float] | None = None, world: DataFrame | None = None, longer: int = 5) -> DataFrame:
    """unit, crop, price, step: the first of these steps that has a price.

    recent: the unit's median in the years `recent`; longer: its median from `longer` years before them on; near, of_region, of_continent: the mean of what its
    neighbours, the others of its region, and its continent have in the recent years alone; of_all: the world's median in those years (without `world`, the mean of all units).
    Crops of keep_global take the world price whatever they have, and their continent's only without one. A price under its crop's floor becomes the mean of all units' longer medians (of_longer).

    df: unit, crop, year, price. places: unit, region, continent (every unit). edges: unit, neighbour. world: crop, year, price.
    """
    first, last = recent
    now = F.col("year").between(first, last)
    two = df.groupBy("unit", "crop").agg(F.median(F.when(now, F.col("price"))).alias("recent"), F.median(F.when(F.col("year").between(first - longer, last), F.col("price"))).alias("longer"))
    own = places.withColumn("crop", F.explode(listed(df, "crop"))).withColumn("crop", F.col("crop.crop")).join(two, ["unit", "crop"], "left")
    near = edges.join(own.select(F.col("unit").alias("neighbour"), "crop", "recent"), "neighbour").groupBy("unit", "crop").agg(F.avg("recent").alias("near"))
    rows = own.join(near, ["unit", "crop"], "left")
    levels = [("of_region", ["region", "crop"], "recent"), ("of_continent", ["continent", "crop"], "recent"), ("of_longer", ["crop"], "longer")]
    for level, keys, what in levels if world is not None else [*levels, ("of_all", ["crop"], "recent")]:
        rows = rows.join(own.groupBy(*keys).agg(F.avg(what).alias(level)), keys)
    if world is not None:
        rows = rows.join(world.where(now).groupBy("crop").agg(F.median("price").alias("of_all")), "crop", "left")
    steps, fixed = ["recent", "longer", "near", "of_region", "of_continent", "of_all"], ["of_all", "of_continent"]

    def pick(names: list[str]) -> tuple[Column, Column]:
        return F.coalesce(*names), F.coalesce(*(F.when(F.col(n).isNotNull(), F.lit(n)) for n in names))

    kept = F.col("crop").isin(*keep_global)
    price, step = (F.when(kept, a).otherwise(b) for a, b in zip(pick(fixed), pick(steps), strict=True)) if keep_global else pick(steps)
    low = price < F.coalesce(*(F.when(F.col("crop") == c, F.lit(x)) for c, x in (floors or {}).items()), F.lit(-math.inf))
    return rows.select("unit", "crop", F.when(low, F.col("of_longer")).otherwise(price).alias("price"), F.when(low, "of_longer").otherwise(step).alias("step"))


def split_by_ratio(df: DataFrame, ratios: DataFrame, combined: str) -> DataFrame:
    """The combined crop's rows as its parts, by each unit's production; a unit without production by that of all. ratios: unit, part, production."""
    share = ratios.groupBy("part").agg(F.sum("production").alias("_p"))
    share = share.withColumn("_s", safe_ratio("_p", F.sum("_p").over(Window.partitionBy())))  # a row for each part
    own = ratios.withColumn("_r", safe_ratio("production", F.sum("production").over(Window.partitionBy("unit")))).select("unit", "part", "_r")
    rows = df.where(F.col("crop") == combined).select("*", F.inline(listed(share, "part", "_s"))).join(own, ["unit", "part"], "left")
    has = F.max("_r").over(Window.partitionBy("unit")).isNotNull()
    parts = rows.withColumn("value", F.col("value") * F.when(has, F.coalesce("_r", F.lit(0.0))).otherwise(F.col("_s"))).withColumn("crop", F.col("part"))
    return df.where(F.col("crop") != combined).unionByName(parts.select(*df.columns))


def copy_to_siblings(df: DataFrame, siblings: DataFrame) -> DataFrame:
    """df with rows of `crop` again under each sibling that has none of its own in the unit. siblings: crop, sibling."""
    more = df.join(siblings, "crop").withColumn("crop", F.col("sibling")).select(*df.columns)
    return df.unionByName(more.join(df.select("unit", "crop").distinct(), ["unit", "crop"], "left_anti").select(*df.columns))


# --------------------------------------------------------------------------- seasons
def repair_seasons(df: DataFrame, late_countries: list[str], late: int = 30, totals: list[tuple[str, str]] = ()) -> DataFrame:
    """s1, e1, lgp1, s2, e2, lgp2 of a cell, from dekads to months.

    In late_countries a lone season that starts after dekad `late` is the second one, and its totals (pairs of columns: of the first, of the second season; rain, say) go with it. Starts and ends become months (of the day 10 times the dekad after 1 January of a leap year), lengths
    whole months. A season that ends in its first month ends in the next one (13 is January). Last, each null
    of the first season takes the second's value, which becomes null.
    """
    lone = (F.col("s1") > late) & F.col("s2").isNull() & F.col("admin0").isin(*late_countries)
    moves = F.coalesce(lone, F.lit(False))
    out = df.withColumns({c: x for a, b in totals for c, x in ((a, F.when(~moves, F.col(a))), (b, F.when(moves, F.col(a)).otherwise(F.col(b))))}) if totals else df
    for a, b in (("s1", "s2"), ("e1", "e2"), ("lgp1", "lgp2")):
        out = out.withColumn(f"_{a}", F.when(~moves, F.col(a))).withColumn(f"_{b}", F.when(moves, F.col(a)).otherwise(F.col(b)))
    month = {c: F.month(F.date_add(F.lit("2024-01-01").cast("date"), F.col(f"_{c}").cast("int") * 10)) for c in ("s1", "e1", "s2", "e2")}
    out = out.select(*(c for c in df.columns if c not in ("s1", "e1", "lgp1", "s2", "e2", "lgp2")), *(m.alias(f"_{c}") for c, m in month.items()), *(F.ceil(F.col(f"_{c}") / 3).cast("int").alias(f"_{c}") for c in ("lgp1", "lgp2")))
    for i in ("1", "2"):
        ends = F.when(F.col(f"_s{i}") == F.col(f"_e{i}"), F.col(f"_e{i}") + 1).otherwise(F.col(f"_e{i}"))
        out = out.withColumn(f"_e{i}", F.when(ends == 13, 1).otherwise(ends))
    for c in ("s", "e", "lgp"):
        out = out.withColumn(f"{c}1", F.coalesce(f"_{c}1", f"_{c}2")).withColumn(f"{c}2", F.when(F.col(f"_{c}1").isNotNull(), F.col(f"_{c}2")))
    return out.drop("_s1", "_s2", "_e1", "_e2", "_lgp1", "_lgp2")


# --------------------------------------------------------------------------- zones
def merge_claims(df: DataFrame, claims: DataFrame, counts: DataFrame, code: str, keys: list[str], how: str = "mean", value: str = "value", iso3: str = "iso3") -> DataFrame:
    """National rows (null admin1) of disputed areas put together with those of the country that claims them: sum, min, max, or mean by cells.

    A disputed area has a row of its own for each claimant, with the claimant's iso3 (one of the keys): rows of equal keys go together, whatever their code, and take the code
    of that country. All other rows stay as they are, once each. claims: disputed, claimant, iso3 (several rows a disputed code). counts: code, n_cells. A sum of nothing
    is 0, other statistics of nothing are null. The columns keep their order; those that are neither key, code nor value become null in the rows put together.
    """
    if iso3 not in keys:
        raise ValueError(f"{iso3} must be one of the keys")
    codes = claims.select(F.col("disputed").alias(code)).unionByName(claims.select(F.col("claimant").alias(code))).distinct()
    rows = df.join(codes.withColumn("_concerned", F.lit(True)), code, "left")  # a code once
    concerned = F.col("_concerned").isNotNull() & F.col("admin1").isNull()
    weighed = rows.where(concerned).join(counts.select(F.col("code").alias(code), "n_cells"), code, "left")
    n = F.when(F.col(value).isNotNull(), F.coalesce("n_cells", F.lit(0)))
    made = {"sum": F.coalesce(F.sum(value), F.lit(0)), "min": F.min(value), "max": F.max(value), "mean": safe_ratio(F.sum(F.col(value) * n), F.sum(n).cast("double"))}[how]
    of = claims.groupBy(F.col("iso3").alias("_iso3")).agg(F.min("claimant").alias("_claimant"))
    merged = weighed.groupBy(*keys).agg(made.cast(df.schema[value].dataType).alias(value)).join(of, F.col(iso3) == F.col("_iso3"), "left").withColumn(code, F.col("_claimant").cast(df.schema[code].dataType))
    rest = {f.name: F.lit(None).cast(f.dataType) for f in df.schema.fields if f.name not in (*keys, code, value)}
    return rows.where(~concerned).select(*df.columns).unionByName(merged.withColumns(rest).select(*df.columns) if rest else merged.select(*df.columns))


def regrid(df: DataFrame, old: DataFrame, new: DataFrame, pairs: DataFrame) -> DataFrame:
    """Mass to another grid: density by the old cell's area, the nearest old cell for each new one, times the new cell's area.

    df: cell, value. old, new: cell, area. pairs: cell (of the new grid), nearest (of the old one).
    """
    dense = df.join(old, "cell").select(F.col("cell").alias("nearest"), safe_ratio("value", "area").alias("_density"))
    return pairs.join(dense, "nearest").join(new, "cell").select("cell", (F.col("_density") * F.col("area")).alias("value"))


def touching_cells(zones: DataFrame, size: float) -> DataFrame:
    """zone_id, x, y: cells of the size that an edge of the ring (or of one of the rings) passes through, whatever their centre.

    The edge is cut at every grid line that it crosses; the middle of each piece tells its cell.
    """
    zones = with_rings(zones).select("zone_id", F.explode("rings").alias("ring"))
    n = F.size("ring")
    edges = zones.select("zone_id", F.posexplode("ring").alias("i", "a"), n.alias("n"), "ring").select("zone_id", "a", F.get("ring", F.pmod(F.col("i") + 1, F.col("n"))).alias("b"))

    def cuts(c: str) -> Column:
        lo, hi = F.least(F.col(f"a.{c}"), F.col(f"b.{c}")) / size, F.greatest(F.col(f"a.{c}"), F.col(f"b.{c}")) / size
        lines = F.when(F.ceil(lo) <= F.floor(hi), F.sequence(F.ceil(lo), F.floor(hi))).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.when(F.col(f"a.{c}") == F.col(f"b.{c}"), F.array().cast("array<bigint>")).otherwise(lines), lambda k: (k * size - F.col(f"a.{c}")) / (F.col(f"b.{c}") - F.col(f"a.{c}")))

    at = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts("x"), cuts("y"))))
    pieces = edges.withColumn("t", at).select("zone_id", "a", "b", F.explode(F.zip_with(F.slice("t", F.lit(1), F.size("t") - 1), F.slice("t", F.lit(2), F.size("t") - 1), lambda p, q: (p + q) / 2)).alias("t"))
    place = [F.floor((F.col(f"a.{c}") + (F.col(f"b.{c}") - F.col(f"a.{c}")) * F.col("t")) / size).cast("long").alias(c) for c in ("x", "y")]
    return pieces.select("zone_id", *place).distinct()


# --------------------------------------------------------------------------- thresholds, catalogue
#: Severities, and the days beyond a temperature that make each of them.
SEVERITIES, DAYS_WARM, DAYS_HOT = ("Moderate", "Severe", "Extreme"), (7, 14, 21), (1, 5, 10)


def crop_thresholds(species: DataFrame, code: str, direction: str) -> DataFrame:
    """crop, hazard, severity, threshold: mean over a crop's species of the optimal, middle and absolute limit; the middle limit on high rain (direction above) is rounded up, for each species.

    species: crop, opt, mid, abs.
    """
    mid = F.ceil("mid").cast("double") if direction == "above" else F.col("mid")
    each = species.select("crop", F.explode(F.array(*(F.struct(F.lit(s).alias("severity"), c.alias("limit")) for s, c in (("moderate", F.col("opt")), ("severe", mid), ("extreme", F.col("abs")))))).alias("x")).select("crop", "x.severity", "x.limit")
    return each.groupBy("crop", "severity").agg(F.avg("limit").alias("threshold")).withColumn("hazard", F.lit(code))


def ecocrop_thresholds(crops: DataFrame, species: DataFrame) -> DataFrame:
    """index_name, description, direction, crop, threshold: the hazard classes of every crop, from the climatic limits of its species.

    Rain (PTOT) and mean temperature (TAVG), too low (<) and too high (>): moderate is the optimal limit, extreme the absolute one, severe halfway
    (of high rain rounded up, for each species); each the mean over the crop's species. Hot days: NTxM, NTxS and NTxE with the crop's degrees, the mean over its species, rounded up, of the
    whole degrees of the optimal limit, the halfway one rounded up, and the whole degrees of the absolute one; the thresholds are days of a month. A species without limits is left out, a null limit isn't counted.

    crops: crop, sci_name (species, parted by ;). species: species and {temp,rain}_{opt,abs}_{min,max}.
    """
    own = crops.select("crop", F.explode(F.array_distinct(F.transform(F.split("sci_name", ";"), lambda s: F.trim(s)))).alias("species")).join(species, "species")
    c = F.col
    halfway = {f"{v}_{e}": (c(f"{v}_opt_{e}") + c(f"{v}_abs_{e}")) / 2 for v in ("temp", "rain") for e in ("min", "max")}
    limits = {
        ("PTOT", "<"): (c("rain_opt_min"), halfway["rain_min"], c("rain_abs_min")), ("PTOT", ">"): (c("rain_opt_max"), F.ceil(halfway["rain_max"]), c("rain_abs_max")),
        ("TAVG", "<"): (c("temp_opt_min"), halfway["temp_min"], c("temp_abs_min")), ("TAVG", ">"): (c("temp_opt_max"), halfway["temp_max"], c("temp_abs_max")),
    }
    hot = {"NTxM": (c("temp_opt_max").cast("long"), DAYS_WARM), "NTxS": (F.ceil(halfway["temp_max"]), DAYS_WARM), "NTxE": (c("temp_abs_max").cast("long"), DAYS_HOT)}
    means = own.groupBy("crop").agg(*(F.avg(x.cast("double")).alias(f"{k}{d}{s}") for (k, d), xs in limits.items() for s, x in zip(SEVERITIES, xs, strict=True)), *(F.ceil(F.avg(x)).alias(k) for k, (x, _) in hot.items()))
    rows = [F.struct(F.lit(k).alias("index_name"), F.lit(s).alias("description"), F.lit(d).alias("direction"), F.col(f"`{k}{d}{s}`").alias("threshold")) for k, d in limits for s in SEVERITIES]
    rows += [F.struct(F.concat(F.lit(k), F.col(k).cast("string")).alias("index_name"), F.lit(s).alias("description"), F.lit(">").alias("direction"), F.lit(float(n)).alias("threshold")) for k, (_, days) in hot.items() for s, n in zip(SEVERITIES, days, strict=True)]
    return means.select("crop", F.inline(F.array(*rows))).where("index_name is not null").select("index_name", "description", "direction", "crop", "threshold")


def inherit_thresholds(generic: DataFrame, animals: DataFrame, heat: list[str]) -> DataFrame:
    """The generic crop's thresholds under each animal, but those on heat. generic: hazard, severity, threshold. animals: crop."""
    return generic.where(~F.col("hazard").isin(*heat)).select(F.inline(listed(animals, "crop")), "hazard", "severity", "threshold")


@dataclass(frozen=True)
class Interaction:
    """One heat, wet and dry hazard by their short names, and which of them are fixed: the same index whatever the crop. kind: crop or animal."""

    heat: str
    wet: str
    dry: str
    heat_fixed: bool = False
    wet_fixed: bool = False
    dry_fixed: bool = False
    kind: str = "crop"


def fixed_or_free(interactions: list[Interaction]) -> None:
    """A hazard that is fixed in one interaction and free in another is an error: its short name would stand for several thresholds."""
    sides = {True: set(), False: set()}
    for i in interactions:
        for name, fixed in ((i.heat, i.heat_fixed), (i.wet, i.wet_fixed), (i.dry, i.dry_fixed)):
            sides[fixed].add(name)
    both = sorted(sides[True] & sides[False])
    if both:
        raise ValueError("both fixed and free: " + ", ".join(both))


def interaction_table(classes: DataFrame, interactions: list[Interaction], animals: str = "-tropical|-highland", short: list[str] = ()) -> DataFrame:
    """crop, severity, heat, wet, dry (full names), the three short names, kind, code (dry+heat+wet) and in_short, for each crop and severity that has all three hazards.

    classes: crop, severity, hazard (short name), file (the full name's file). Interactions of kind animal go with crops like `animals`, the others with all other crops. in_short:
    a crop of the short list (never an animal).
    """
    fixed_or_free(interactions)
    own = classes.select("crop", "severity", "hazard", F.replace(F.regexp_replace("file", r"\.tif", ""), F.lit("_"), F.lit("-")).alias("full")).distinct()
    of = F.when(F.col("crop").rlike(animals), "animal").otherwise("crop")
    each = F.array(*(F.struct(F.lit(i.kind).alias("kind"), *(F.lit(getattr(i, n)).alias(f"{n}_simple") for n in ("heat", "wet", "dry"))) for i in sorted(set(interactions), key=str)))
    rows = own.select("crop", "severity").distinct().select("crop", "severity", F.inline(each)).where(F.col("kind") == of)
    for n in ("heat", "wet", "dry"):
        rows = rows.join(own.select("crop", "severity", F.col("hazard").alias(f"{n}_simple"), F.col("full").alias(n)), ["crop", "severity", f"{n}_simple"])  # incomplete ones drop out
    return rows.withColumns({"code": F.concat_ws("+", "dry", "heat", "wet"), "in_short": F.col("crop").isin(*short) & (F.col("kind") == "crop")})


def distinct_combinations(table: DataFrame) -> DataFrame:
    """What has to be computed once, whichever crops share it: severity, kind, short and full names and code without the crop, and whether the short list needs it; in the order of the codes."""
    keys = [c for c in table.columns if c not in ("crop", "in_short")]
    return table.groupBy(*keys).agg(F.max("in_short").alias("in_short")).orderBy("code", "severity", "kind")


def interaction_catalogue(thresholds: DataFrame, combos: DataFrame) -> DataFrame:
    """crop, severity, heat, wet, dry and the three thresholds of every combination whose thresholds are all there.

    thresholds: crop, hazard, severity, threshold. combos: heat, wet, dry. A combination that names a hazard twice is an error.
    """
    if not combos.where("heat = wet or wet = dry or heat = dry").isEmpty():
        raise ValueError("a combination names a hazard twice")
    rows = combos.distinct()
    for n, part in enumerate(("heat", "wet", "dry")):
        own = thresholds.select("crop", "severity", F.col("hazard").alias(part), F.col("threshold").alias(f"{part}_threshold"))
        rows = rows.join(own, [part] if n == 0 else ["crop", "severity", part])  # inner: incomplete ones drop out
    return rows.select("crop", "severity", "heat", "wet", "dry", "heat_threshold", "wet_threshold", "dry_threshold").distinct()


def crop_bundle(freq: DataFrame, catalogue: DataFrame) -> DataFrame:
    """freq rows (crop, severity, hazard, ...) of the hazards that the catalogue names for the crop; a missing one is an error."""
    wanted = catalogue.select("crop", "severity", F.explode(F.array("heat", "wet", "dry")).alias("hazard")).distinct()
    lost = wanted.join(freq.select("crop", "severity", "hazard").distinct(), ["crop", "severity", "hazard"], "left_anti").limit(5).collect()
    if lost:
        raise ValueError("no frequency of " + ", ".join(sorted("/".join(r) for r in lost)))
    return freq.join(wanted, ["crop", "severity", "hazard"], "left_semi")


# --------------------------------------------------------------------------- labels
def relabel(label: str | Column, rules: list[tuple[str, str]]) -> Column:
    """The regular expressions replaced one after the other, in their order."""
    out = col(label)
    for pattern, by in rules:
        out = F.regexp_replace(out, pattern, by)
    return out


def split_label(df: DataFrame, label: str, fields: list[str], rules: list[tuple[str, str]] = (), mark: str = "_") -> DataFrame:
    """df with the fields of the relabelled label, null where there are too few, and `n_missing`, the fields without a value; too many make all of them null."""
    parts = F.split(relabel(label, list(rules)), mark)
    right = F.size(parts) <= len(fields)
    got = {f: F.when(right, F.nullif(F.get(parts, F.lit(i)), F.lit(""))) for i, f in enumerate(fields)}
    out = df.withColumns(got)
    return out.withColumn("n_missing", sum((F.col(f).isNull().cast("int") for f in fields), F.lit(0)))


def analytic_subset(df: DataFrame, crop_combo: str, animal_combos: dict[str, str], severities: list[str], periods: list[tuple[str, str]], without: list[str]) -> DataFrame:
    """Rows that the analysis needs: a crop with crop_combo, an animal with its own heat index combination, some severities and (scenario, timeframe) pairs, without some crops."""
    wanted = F.coalesce(*(F.when(F.col("crop") == a, F.lit(c)) for a, c in animal_combos.items()), F.lit(crop_combo))
    key = F.concat_ws("|", "scenario", "timeframe")
    return df.where((F.col("hazard_vars") == wanted) & F.col("severity").isin(*severities) & key.isin(*("|".join(p) for p in periods)) & ~F.col("crop").isin(*without)).withColumn("scenario_x_time", F.concat_ws("-", "scenario", "timeframe"))


def exposure_subset(df: DataFrame, drop: str, suffix: str = "-(tropical|highland)$") -> DataFrame:
    """admin0, admin1, crop, value of rows for all technologies (or none named) above admin2, without crops like `drop`; kinds of one animal are summed."""
    own = df.where((F.col("tech").isNull() | (F.col("tech") == "all")) & F.col("admin2").isNull() & ~F.col("crop").rlike(drop))
    return own.groupBy("admin0", "admin1", F.regexp_replace("crop", suffix, "").alias("crop")).agg(F.sum("value").alias("value"))


#: How adaptation tables code effects.
EFFECTS = {-1: "decrease", 0: "no change", 1: "increase"}


def recoded(df: DataFrame, codes: dict[str, str], marks: dict[str, tuple[str, str]], keys: list[str], labels: dict[int, str] | None = None) -> DataFrame:
    """Distinct rows of the keys, each code column (old: new name) as its label, null if it has none, and for each mark (new: column, text) whether the column contains the text."""
    of = F.create_map(*(F.lit(x) for kv in (labels or EFFECTS).items() for x in kv))
    return df.select(*keys, *(F.try_element_at(of, F.col(a).cast("int")).alias(b) for a, b in codes.items()), *(F.contains(c, F.lit(t)).alias(n) for n, (c, t) in marks.items())).distinct()


# --------------------------------------------------------------------------- statistics
def t_p_value(t: str | Column, df: str | Column) -> Column:
    """Two-sided p of Student's t with a whole number of degrees of freedom: the finite series in the angle's cosine."""
    theta = F.atan(F.abs(col(t)) / F.sqrt(col(df).cast("double")))
    odd, c2 = col(df) % 2 == 1, F.pow(F.cos(theta), 2)

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * c2 * F.when(odd, 2.0 * k / (2.0 * k + 1)).otherwise((2.0 * k - 1) / (2.0 * k))
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    last = F.when(odd, (col(df) - 3) / 2).otherwise((col(df) - 2) / 2).cast("int")
    terms = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(terms, F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")), add)["sum"]
    inside = F.when(odd, 2 / math.pi * (theta + F.when(col(df) > 1, F.sin(theta) * F.cos(theta) * series).otherwise(0.0))).otherwise(F.sin(theta) * series)
    return F.when(col(df) >= 1, F.greatest(1 - inside, F.lit(0.0)))


def detrended_variation(df: DataFrame, keys: list[str], x: str, y: str, least: int = 10, p_below: float = 0.05, r2_above: float = 0.1) -> DataFrame:
    """cv of the residuals round the mean where the trend counts: at least `least` values that aren't all equal, p < p_below and adjusted R2 > r2_above; else null."""
    rows = df.where(F.col(y).isNotNull())
    fit = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(y).alias("_kinds"), F.regr_r2(y, x).alias("_r2"), F.regr_syy(y, x).alias("_syy"), F.avg(y).alias("_mean"))
    n = F.col("n")
    fit = fit.withColumns({"adj_r2": 1 - (1 - F.col("_r2")) * (n - 1) / F.nullif(n - 2, F.lit(0)), "_t": F.sqrt(F.col("_r2") * (n - 2) / F.nullif(1 - F.col("_r2"), F.lit(0.0)))})
    fit = fit.withColumn("p", F.when(F.col("_r2") >= 1, 0.0).otherwise(t_p_value("_t", (n - 2).cast("int"))))
    ok = (n >= least) & (F.col("_kinds") > 1) & (F.col("p") < p_below) & (F.col("adj_r2") > r2_above)
    return fit.select(*keys, "n", "adj_r2", "p", F.when(ok, safe_ratio(F.sqrt(F.col("_syy") * (1 - F.col("_r2")) / (n - 1)), "_mean")).alias("cv"))


def method_quality(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Of each method: mean, sd and CV of y / x, adjusted R2, RMSE and MAE of the line of y on x."""
    fit = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"), F.regr_r2(y, x).alias("_r2"), F.count(F.lit(1)).alias("_n"))
    rows = df.join(fit, keys).withColumn("_e", F.col(y) - F.col("_a") - F.col("_b") * F.col(x)).withColumn("_q", safe_ratio(y, x))
    adj = 1 - (1 - F.first("_r2")) * (F.first("_n") - 1) / F.nullif(F.first("_n") - 2, F.lit(0))
    return rows.groupBy(*keys).agg(F.avg("_q").alias("ratio"), F.stddev_samp("_q").alias("ratio_sd"), safe_ratio(F.stddev_samp("_q"), F.avg("_q")).alias("ratio_cv"), adj.alias("adj_r2"), F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"), F.avg(F.abs("_e")).alias("mae"))


# --------------------------------------------------------------------------- returns
def cash_flow(df: DataFrame, keys: list[str], rate: float, years: int, delay: int, total_cost: str = "cost", benefit: str = "benefit", t: str = "t") -> DataFrame:
    """keys, t, cost_t, benefit_t, bcr, from a year 0 on: costs are paid evenly over the project's years, benefits come `delay` years late, both discounted and cumulated.

    df: keys, t (1, 2, ...), benefit of the year, cost of the whole project.
    """
    zero = df.groupBy(*keys).agg(F.max(total_cost).alias(total_cost)).withColumn(t, F.lit(0)).withColumn(benefit, F.lit(0.0))
    rows = df.select(*keys, t, benefit, total_cost).unionByName(zero.select(*keys, t, benefit, total_cost))
    own = Window.partitionBy(*keys).orderBy(t)
    late = F.lag(benefit, delay, 0.0).over(own) if delay else F.col(benefit)
    rows = rows.withColumns({"benefit_t": late, "cost_t": F.when(F.col(t) < years, F.col(total_cost) / years).otherwise(0.0)})
    d, upto = F.pow(F.lit(1 + rate), F.col(t)), own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(*keys, t, "cost_t", "benefit_t", safe_ratio(F.sum(F.col("benefit_t") / d).over(upto), F.sum(F.col("cost_t") / d).over(upto)).alias("bcr"))


def impact_effects(df: DataFrame, impacts: list[float], services: list[float], bcrs: list[float], digits: int | None = None) -> DataFrame:
    """df (result, cv) with impact, service, bcr, with_impact, marginal, marginal_service, both, benefit for every combination.

    A service level cuts the CV by that share; the loss that it avoids raises the result with impact. Without a CV it adds nothing. The
    project's benefit is what the margin leaves after costs at the benefit-cost ratio.
    """

    def rounded(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    for name, values in (("impact", impacts), ("service", services), ("bcr", bcrs)):
        df = df.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    df = df.withColumn("with_impact", rounded(F.col("result") * (1 + F.col("impact")))).withColumn("marginal", rounded(F.col("with_impact") - F.col("result")))
    loss = avoided_loss("cv", F.col("cv") * (1 - F.col("service")))
    df = df.withColumn("marginal_service", F.coalesce(rounded(F.col("with_impact") * (1 + loss)) - F.col("with_impact"), F.lit(0.0)))
    return df.withColumn("both", F.col("marginal") + F.col("marginal_service")).withColumn("benefit", F.col("both") - F.col("both") / F.col("bcr"))


def converted(df: DataFrame, rates: DataFrame, fixes: DataFrame) -> DataFrame:
    """df with nominal and international dollars: local / rate and local / ppp of the country and year. rates: iso3, year, rate, ppp. fixes: iso3, factor (redenominations)."""
    rows = df.join(rates, ["iso3", "year"], "left").join(fixes, "iso3", "left").withColumn("_v", F.col("value") * F.coalesce("factor", F.lit(1.0)))
    return rows.withColumns({"usd": safe_ratio("_v", "rate"), "intl": safe_ratio("_v", "ppp")}).drop("_v", "factor", "rate", "ppp")


def hazard_index(risk: DataFrame, weights: DataFrame, how: str = "sum") -> DataFrame:
    """cell, index, crop: hazard scores weighted by the crops' shares (sum), or those of the crop with the largest share (max; equal ones joined).

    risk: cell, crop, score. weights: cell, crop, value.
    """
    own = Window.partitionBy("cell")
    rows = risk.join(weights.withColumn("_share", safe_ratio("value", F.sum("value").over(own))), ["cell", "crop"])
    if how == "max":
        rows = rows.withColumn("_top", F.max("_share").over(own)).where(F.col("_share") == F.col("_top"))
        return rows.groupBy("cell").agg(F.avg("score").alias("index"), F.array_join(F.array_sort(F.collect_set("crop")), "+").alias("crop"))
    return rows.groupBy("cell").agg(F.sum(F.col("score") * F.col("_share")).alias("index"), F.max_by("crop", F.struct("_share", "crop")).alias("crop"))


# --------------------------------------------------------------------------- masks, calendars, herds
def mask_split(df: DataFrame, mask: DataFrame, label: str, cell: str = "cell", yes: str = "highland", no: str = "tropical", value: str = "value") -> DataFrame:
    """Two copies of each row: value * inside named label-yes, value * (1 - inside) named label-no. mask: cell, inside (0 or 1); a cell that isn't in it is 0."""
    copies = F.array(*(F.struct(F.lit(name).alias("suffix"), share.alias("share")) for name, share in ((yes, F.col("inside")), (no, 1 - F.col("inside")))))
    rows = df.join(mask, cell, "left").withColumn("inside", F.coalesce("inside", F.lit(0))).withColumn("copy", F.explode(copies))
    return rows.withColumns({label: F.concat_ws("-", label, "copy.suffix"), value: F.col(value) * F.col("copy.share")}).select(*df.columns)


def merged_sowing(df: DataFrame, cell: str = "cell", crop: str = "crop") -> DataFrame:
    """Median and mean over a cell's crops of their sowing month: that of the first season, or of the only one where the first is missing. df: cell, crop, season (first or single), month."""
    of = {s: F.median(F.when(F.col("season") == s, F.col("month"))) for s in ("first", "single")}
    each = df.groupBy(cell, crop).agg(F.coalesce(of["first"], of["single"]).alias("sowing"))
    return each.groupBy(cell).agg(F.median("sowing").alias("median"), F.avg("sowing").alias("mean"))


def livestock_loss(herds: DataFrame, keys: list[str], cattle: str) -> DataFrame:
    """Change of intake weighted by heads, and the losses of each product split by the cattle's share of the heads. herds: keys, animal, heads, change, meat, milk."""
    own = F.coalesce(F.sum(F.when(F.col("animal") == cattle, F.col("heads"))), F.lit(0.0))
    sums = herds.groupBy(*keys).agg(safe_ratio(F.sum(F.col("heads") * F.col("change")), F.sum("heads")).alias("change"), safe_ratio(own, F.sum("heads")).alias("share"), F.sum("meat").alias("meat"), F.sum("milk").alias("milk"))
    long = sums.unpivot([*keys, "change", "share"], ["meat", "milk"], "product", "loss")
    return long.select(*keys, "product", "change", "loss", (F.col("loss") * F.col("share")).alias("cattle_loss"), (F.col("loss") * (1 - F.col("share"))).alias("other_loss"))
