"""Column functions of the naming contract: genome names and ranked taxa."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of sequence files, longest first.
SUFFIXES = (".fasta.gz", ".fasta", ".fa", ".fna", ".fas")
_SUFFIX_RE = "(" + "|".join(s.replace(".", "[.]") for s in SUFFIXES) + ")$"
#: Folders, the three taxa of a file name, a database prefix, the accession, a suffix: one match per name.
_NAME_RE = r"(?s)\A(?:.*/)?(?:[^_/]*_[^_/]*_[^_/]*_)?(?:(?:GB|RS)_)?([^/]*?)" + _SUFFIX_RE.replace("$", r"?\z")


def strip_suffix(name: Column) -> Column:
    return F.regexp_replace(name, _SUFFIX_RE, "")


def stem(name: Column) -> Column:
    """Base name without padding, folders and sequence suffix."""
    return strip_suffix(F.substring_index(F.trim(name), "/", -1))


def accession_of(name: Column) -> Column:
    """The accession a name carries; null for null and blank names.

    A name is an accession, with or without a database prefix, or a file name
    family_genus_species_accession, with or without folders, padding and suffix.
    """
    return F.nullif(F.regexp_extract(F.trim(name), _NAME_RE, 1), F.lit(""))


def parse_file_name(name: Column) -> Column:
    """struct(family, genus, species, accession); empty taxa where the name is not canonical."""
    parts = F.split(stem(name), "_")
    canonical = F.size(parts) >= 4
    return F.struct(
        *(F.when(canonical, parts[i]).otherwise("").alias(n) for i, n in enumerate(("family", "genus", "species"))),
        F.when(canonical, F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(1))), "_"))
        .otherwise(stem(name)).alias("accession"),
    )


def file_name(family: Column, genus: Column, species: Column, accession: Column) -> Column:
    return F.concat(F.concat_ws("_", family, genus, species, accession), F.lit(".fasta"))


def _no_prefix(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(x), "^[A-Za-z]__", ""))


def _token(x: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(x), "[ _]+", "-"), F.lit(""))


def rank_name(x: Column) -> Column:
    """A family or genus in canonical spelling and lower case; null if null or blank."""
    return _token(_no_prefix(x))


def species_name(species: Column, genus: Column) -> Column:
    """A species epithet in canonical spelling and lower case, without its genus; null if blank."""
    s, g = F.lower(_no_prefix(species)), F.lower(_no_prefix(genus))
    # strip the genus only as a leading word of its own
    rest = F.when(
        (F.length(g) > 0) & F.startswith(s, g) & F.substring(s, F.length(g) + 1, F.lit(1)).isin(" ", "_", ""),
        F.substring(s, F.length(g) + 2, F.length(s)),
    ).otherwise(s)
    return _token(F.trim(rest))
