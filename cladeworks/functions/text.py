"""Column functions for taxonomy strings, tokens, headers and options."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ranks of a lineage string and their prefixes.
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")


def _clean(x: Column) -> Column:
    return F.translate(F.replace(x, F.lit(" "), F.lit("")), "_", "-")


def lineage_struct(raw: Column) -> Column:
    """struct of all ranks of a string like d__A;p__B;...;s__G e; absent ranks are ''.

    The species loses its genus, blanks and underscores; genus and family lose blanks and underscores.
    The last part of a rank counts. A name that has a rank prefix already loses it: f__f__A is A, and so is each
    word of a species, s__g__G s__e. Null gives empty ranks.
    """
    parts = F.split(F.coalesce(raw, F.lit("")), ";")

    def last(rank):
        hits = F.filter(parts, lambda p: F.startswith(p, F.lit(rank[0] + "__")))
        return F.coalesce(F.regexp_replace(F.try_element_at(hits, F.lit(-1)), r"^(\s*[A-Za-z]__)+", ""), F.lit(""))

    genus = last("genus")
    made = {r: last(r) for r in RANKS}
    made["species"] = F.regexp_replace(made["species"], r"(^|\s)(\s*[A-Za-z]__)+", "$1")
    made["species"] = _clean(F.when(genus == "", made["species"]).otherwise(F.replace(made["species"], genus, F.lit(""))))
    made["genus"], made["family"] = _clean(genus), _clean(made["family"])
    return F.struct(*(x.alias(r) for r, x in made.items()))


def taxon_string(rank: str, name: Column) -> Column:
    """g__Name with the first word capitalised and the rest as given."""
    n = F.translate(F.trim(name), "_", " ")
    return F.concat(F.lit(rank[0] + "__"), F.upper(F.substring(n, 1, 1)), F.substring(n, 2, F.length(n)))


def token(name: Column) -> Column:
    """One safe word: blanks and underscores to hyphens, other signs dropped, '' to NA."""
    t = F.regexp_replace(F.translate(F.trim(name), " _", "--"), "[^A-Za-z0-9.-]", "")
    return F.coalesce(F.nullif(t, F.lit("")), F.lit("NA"))


def isolate_token(name: Column) -> Column:
    return F.concat(F.lit("iso-"), token(name))


def norm(x: Column) -> Column:
    """For comparison: lower case without hyphens, underscores and blanks."""
    return F.translate(F.lower(x), "-_ ", "")


def classify(lineage: Column, organism: Column) -> Column:
    """struct(family, genus, species) from a lineage array of names, top rank first, by name endings."""
    names = F.filter(F.coalesce(lineage, F.array().cast("array<string>")), lambda n: n != "")
    species = F.coalesce(F.nullif(organism, F.lit("")), F.try_element_at(names, F.lit(-1)), F.lit(""))
    family = F.coalesce(F.try_element_at(F.filter(names, lambda n: F.lower(n).endswith("viridae")), F.lit(1)), F.lit(""))
    single = F.filter(names, lambda n: ~n.contains(" ") & F.lower(n).endswith("virus") & (n != species))
    above = F.try_element_at(names, F.lit(-2))
    genus = F.coalesce(F.try_element_at(single, F.lit(-1)), F.when(~above.contains(" "), above), F.lit(""))
    return F.struct(token(family).alias("family"), token(genus).alias("genus"), token(species).alias("species"))


def header_struct(header: Column) -> Column:
    """struct(genome_id, taxid, species, name) of a header `name | x | id] [species | tag`."""
    gid = F.split_part(F.split_part(header, F.lit("]"), F.lit(1)), F.lit("| "), F.lit(-1))
    return F.struct(
        gid.alias("genome_id"), F.split_part(gid, F.lit("."), F.lit(1)).alias("taxid"),
        F.trim(F.split_part(F.split_part(header, F.lit("["), F.lit(2)), F.lit(" | "), F.lit(1))).alias("species"),
        F.split_part(header, F.lit(" "), F.lit(1)).alias("name"),
    )


def as_percent(x: Column) -> Column:
    return F.when(x <= 1, x * 100).otherwise(x)


def percent_text(x: Column) -> Column:
    """A percentage or fraction as a percentage of six significant digits, without trailing zeros; for 0 and 0.001 to 99,999."""
    v = as_percent(x)
    size = F.when(v == 0, 1).otherwise(F.floor(F.log10(F.abs(v))) + 1)
    unit = F.pow(F.lit(10.0), 6 - size)
    shown = F.replace(F.format_number(F.bround(v * unit) / unit, 8), F.lit(","), F.lit(""))
    return F.regexp_replace(F.regexp_replace(shown, "0+$", ""), "[.]$", "")


def at_least(version: Column, floor: tuple[int, int, int], strict: bool = True) -> Column:
    """Whether a version_struct reaches a floor; lenient: a version of 0.0.0, which could not be read, passes."""
    v = F.struct(version["major"], version["minor"], version["patch"])
    ok = v >= F.struct(*(F.lit(x) for x in floor))
    return ok if strict else ok | (v == F.struct(F.lit(0), F.lit(0), F.lit(0)))


def version_struct(text: Column) -> Column:
    def part(i):
        return F.coalesce(F.nullif(F.regexp_extract(text, r"([0-9]+)(?:[.]([0-9]+))?(?:[.]([0-9]+))?", i), F.lit("")).cast("int"), F.lit(0))

    return F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch"))


def option_list(x: Column) -> Column:
    """a, B ,c -> [a, b, c]; empty entries dropped."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda v: F.lower(F.trim(v))), lambda v: v != "")


def key_values(x: Column) -> Column:
    """'a=1, b=2' -> map; of repeated keys the last counts, blank entries are left out, an entry without a key is an error."""
    entries = F.filter(F.split(F.coalesce(x, F.lit("")), ","), lambda v: F.trim(v) != "")
    pairs = F.transform(entries, lambda v: F.split(v, "=", 2))
    good = F.forall(pairs, lambda p: (F.size(p) == 2) & (F.trim(p[0]) != ""))
    checked = F.when(good, pairs).otherwise(F.raise_error(F.concat(F.lit("an option is written key=value: "), x)))
    return F.aggregate(
        checked, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")),
        lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != F.trim(p[0])), F.create_map(F.trim(p[0]), F.trim(p[1]))),
    )


#: IUPAC letters and their complements.
IUPAC = ("ACGTRYKMBVDHacgtrykmbvdh", "TGCAYRMKVBHDtgcayrmkvbhd")


def reverse_complement(seq: Column) -> Column:
    """Over the IUPAC letters in both cases; other signs stay."""
    return F.translate(F.reverse(seq), *IUPAC)


def tree_label(x: Column) -> Column:
    return F.translate(x, " ()[]:,;'", "_________")


def wrap(seq: Column, width: int = 80) -> Column:
    """A sequence in lines of `width` signs."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")
