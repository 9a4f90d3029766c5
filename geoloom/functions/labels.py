"""Census-style variable lists: which variables count, and short column names for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that say nothing in a column name, label segments without meaning, the longest name.
FILLERS = ["the", "of", "and", "or", "in", "to", "for", "by"]
STRUCTURAL = ["estimate", "margin of error", "total", "annotation of estimate", "annotation of margin of error"]
MOST = 63
# Short forms of census words; callers pass longer tables as a parameter. A word without one stays as it is, an
# empty form drops the word.
ABBREVIATIONS = {
    "estimate": "est", "margin": "mrgn", "error": "err", "annotation": "ann", "total": "tot", "percent": "pct", "percentage": "pct", "median": "med", "aggregate": "agg", "average": "avg", "number": "num", "characteristics": "chars",
    "population": "pop", "civilian": "civ", "female": "f", "male": "m", "years": "yr", "year": "yr", "under": "un", "over": "ov", "white": "wht", "black": "blk", "african": "afr", "american": "amer", "asian": "asn", "hispanic": "hisp", "latino": "lat",
    "native": "nat", "hawaiian": "haw", "pacific": "pac", "islander": "isl", "indian": "ind", "alaska": "ak", "alone": "aln", "combination": "comb", "citizen": "ctzn", "citizenship": "ctzn", "naturalized": "ntrl", "foreign": "frgn", "born": "brn",
    "residence": "res", "metropolitan": "metro", "micropolitan": "micro", "statistical": "stat", "principal": "princ", "outside": "out", "inside": "in", "urbanized": "urb", "urban": "urb", "rural": "rrl", "central": "cntrl", "county": "cnty", "place": "plc",
    "employed": "emp", "unemployed": "unemp", "income": "inc", "earnings": "earn", "poverty": "pov", "occupation": "occ", "occupations": "occ", "management": "mgmt", "business": "bus", "science": "sci", "financial": "fin", "operations": "ops",
    "computer": "comp", "computing": "comp", "engineering": "eng", "mathematical": "math", "production": "prod", "transportation": "transpo", "material": "matrl", "moving": "mov", "construction": "constr", "extraction": "extr", "installation": "instl",
    "maintenance": "maint", "repair": "repr", "service": "srvc", "services": "srvc", "professional": "prof", "protective": "prot", "education": "edu", "educational": "edu", "training": "trn", "library": "lib", "healthcare": "hlth", "health": "hlth",
    "support": "supp", "practitioner": "pract", "practitioners": "pract", "technical": "tech", "architecture": "arch", "community": "comm", "social": "soc", "legal": "law", "building": "bldg", "grounds": "grnds", "cleaning": "cln", "preparation": "prep",
    "serving": "srvg", "related": "rel", "personal": "pers", "sales": "sls", "office": "ofc", "administrative": "admin", "natural": "nat", "resources": "rsrc", "farming": "farm", "fishing": "fish", "forestry": "frst", "workers": "wrkrs", "worker": "wrkr",
    "physical": "phys", "housing": "hous", "household": "hh", "households": "hh", "owner": "own", "renter": "rnt", "occupied": "occ", "vacant": "vac", "tenure": "tnr", "mortgage": "mtg", "rent": "rnt", "rooms": "rms", "room": "rm", "bedrooms": "bdrms",
    "bedroom": "bdrm", "vehicles": "veh", "vehicle": "veh", "available": "avail", "selected": "sel", "conditions": "cond", "monthly": "mo", "costs": "cst", "value": "val", "structure": "struc", "structures": "struc", "built": "blt", "heating": "heat",
    "utility": "util", "telephone": "tel", "plumbing": "plmb", "kitchen": "ktchn", "facilities": "fac", "internet": "inet", "subscription": "sub", "subscriptions": "sub", "broadband": "bband", "device": "dev", "devices": "dev", "type": "typ",
    "commuting": "cmtg", "means": "", "drove": "drv", "carpooled": "crpl", "public": "pub", "transit": "trns", "walked": "wlk", "bicycle": "bike", "taxicab": "taxi", "motorcycle": "moto", "worked": "wrkd", "home": "hm", "travel": "trvl", "time": "tm",
    "departure": "dep", "minutes": "min", "arrival": "arr", "including": "incl", "excluding": "excl", "without": "wo", "with": "w", "children": "chld", "families": "fam", "family": "fam", "people": "ppl", "persons": "prsn", "level": "lvl", "status": "stat",
    "attainment": "attn", "insurance": "ins", "coverage": "cov", "disability": "disab", "language": "lang", "spoken": "spkn", "english": "eng", "ability": "abil", "speak": "spk", "graduate": "grad", "degree": "deg", "school": "schl", "college": "clg",
    "enrolled": "enrl", "earlier": "elr", "later": "ltr", "other": "oth", "two": "2",
}


def variable_filter(df: DataFrame) -> DataFrame:
    """Estimates and margins: codes that end in E or M but not EA, MA, PE or PM, with a type, without NAME; each once."""
    v = F.col("variable")
    ok = v.rlike("[EM]$") & ~v.rlike("(EA|MA|PE|PM)$") & (v != "NAME") & F.col("predicate_type").isNotNull()
    return df.where(ok).select("variable", "label", "concept").distinct()


def _words(text: Column, abbreviations: dict[str, str]) -> Column:
    """Lower-case words of letters and digits (other characters vanish), without filler, abbreviated."""
    table = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv]) if abbreviations else F.create_map().cast("map<string,string>")
    raw = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", ""), r"\s+"), lambda w: (w != "") & ~w.isin(FILLERS))
    return F.filter(F.transform(raw, lambda w: F.coalesce(table[w], w)), lambda w: w != "")


def _once(words: Column) -> Column:
    """Of consecutive equal words one."""
    return F.transform(F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), F.when(i > 0, F.get(words, i - 1)).alias("p"))), lambda s: s["p"].isNull() | (s["p"] != s["w"])), lambda s: s["w"])


def _fit(words: Column, room: Column) -> Column:
    """As many whole words, joined by '_', as fit."""
    sizes = F.sequence(F.size(words), F.lit(0), F.lit(-1))
    return F.filter(F.transform(sizes, lambda n: F.array_join(F.slice(words, 1, n), "_")), lambda s: F.length(s) <= F.greatest(room, F.lit(0)))[0]


def compress_labels(df: DataFrame, abbreviations: dict[str, str] | None = None) -> DataFrame:
    """variable and column_name: concept__label_{est|moe}_{variable}, at most 63 characters. The variable is never cut; the
    concept loses its last words first, then the label. A label without words is 'tot'. Variables that end neither in E nor
    in M after their number have no name and no row."""
    table = ABBREVIATIONS if abbreviations is None else abbreviations
    ending = F.regexp_extract("variable", r"[0-9]([A-Z]+)$", 1)
    segments = F.transform(F.split(F.coalesce("label", F.lit("")), "!!"), lambda p: F.regexp_replace(F.trim(p), ":+$", ""))
    label = _once(F.flatten(F.transform(F.filter(segments, lambda p: ~F.lower(p).isin(STRUCTURAL)), lambda p: _words(p, table))))
    out = df.where(ending.isin("E", "M")).withColumns(
        {"_label": label, "_concept": _once(_words(F.coalesce("concept", F.lit("")), table)), "_tail": F.concat(F.when(ending == "M", "_moe_").otherwise("_est_"), F.col("variable"))}
    )
    out = out.withColumn("_label", F.when(F.size("_label") == 0, F.array(F.lit("tot"))).otherwise(F.col("_label")))
    room = F.lit(MOST - 2) - F.length("_tail")
    out = out.withColumn("_c", _fit(F.col("_concept"), room - F.length(F.array_join("_label", "_"))))
    out = out.withColumn("_l", _fit(F.col("_label"), room - F.length("_c")))
    return out.select("variable", F.concat(F.array_join(F.filter(F.array("_c", "_l"), lambda x: x != ""), "__"), "_tail").alias("column_name"))
