"""Readers and writers of the text tables that pipelines exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import accession_of
from ..functions.text import lineage_struct


def _tsv(spark: SparkSession, path, schema: str | None = None, header: bool = True, sep: str = "\t") -> DataFrame:
    r = spark.read.options(sep=sep, header=header, mode="PERMISSIVE", quote="" if sep == "\t" else '"')
    return (r.schema(schema) if schema else r).csv(path)


def taxonomy(spark: SparkSession, path) -> DataFrame:
    """(accession, is_rep, ranks...) of a genome taxonomy table with accession, its taxonomy and its representative."""
    raw = _tsv(spark, path)
    prefix = "^(GB|RS)_"
    acc = F.regexp_replace("accession", prefix, "")
    rep = F.regexp_replace("gtdb_genome_representative", prefix, "")
    return raw.select(acc.alias("accession"), (acc == rep).alias("is_rep"), lineage_struct(F.col("gtdb_taxonomy")).alias("t")).select("accession", "is_rep", "t.*")


SELECTION = "accession string, family string, genus string, species string, is_outgroup string, filename string"


def read_selection(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, SELECTION).fillna("").withColumn("is_outgroup", F.col("is_outgroup") == "1")


def selection(manifest: DataFrame) -> DataFrame:
    """The selection table of a manifest: nulls as '', the outgroup flag as 0 or 1."""
    return manifest.select(
        "accession", *(F.coalesce(c, F.lit("")).alias(c) for c in ("family", "genus", "species")),
        F.when(F.col("is_outgroup"), "1").otherwise("0").alias("is_outgroup"), F.coalesce("filename", F.lit("")).alias("filename"),
    )


def read_clusters(spark: SparkSession, path) -> DataFrame:
    """(representative, member) without self rows and short rows."""
    return _tsv(spark, path, "representative string, member string").where("member is not null and member != representative")


def clusters(rows: DataFrame) -> DataFrame:
    """(representative, member, ord): the representative's own row first, then its other members by name."""
    own = rows.select("representative", F.col("representative").alias("member"), F.lit(0).alias("ord"))
    rest = rows.where("member != representative").select("representative", "member", F.lit(1).alias("ord"))
    return own.unionByName(rest).distinct()


def sorted_once(edges: DataFrame, order: str) -> DataFrame:
    """(child, parent, ord): each edge once, at its first place."""
    return edges.groupBy("child", "parent").agg(F.min(order).alias("ord"))


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """A tab-separated table without quotes; values stay as they are, padding included."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(sep="\t", header=header, quote="", emptyValue="", **keep).csv(path)


def matrix(spark: SparkSession, path) -> DataFrame:
    """(i, j, label, s): a square comma-separated matrix with a header of labels, as long rows."""
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    first = lines.orderBy("n").first()
    labels = [x.strip().strip('"') for x in (first["value"] if first else "").split(",")]
    named = F.array(*(F.lit(x) for x in labels))
    body = lines.where(F.col("n") > F.lit(first["n"] if first else 0))
    from ..operators.compose import positions

    rows = positions(body, "n", name="i").select("i", F.posexplode(F.split("value", ",")).alias("j", "s"))
    return rows.select("i", "j", F.try_element_at(named, F.col("i").cast("int") + 1).alias("a"), F.try_element_at(named, F.col("j") + 1).alias("b"), F.col("s").try_cast("double").alias("s"))


def distance_matrix(spark: SparkSession, path) -> DataFrame:
    """(s, o, d): distances of a tab-separated matrix between labels S_... and O_..., their prefixes cut."""
    raw = _tsv(spark, path)
    cols = [f"c{i}" for i in range(len(raw.columns))]
    heads = F.create_map(*(F.lit(x) for pair in zip(cols, raw.columns) for x in pair))
    long = raw.toDF(*cols).unpivot(cols[:1], cols[1:], "c", "d").select(F.col("c0").alias("row"), heads[F.col("c")].alias("col"), "d")
    return long.where(F.startswith("col", F.lit("S_")) & F.startswith("row", F.lit("O_"))).select(
        F.substring("col", 3, F.length("col")).alias("s"), F.substring("row", 3, F.length("row")).alias("o"), F.col("d").try_cast("double").alias("d")
    )


def _base(c: str):
    return F.substring_index(F.trim(c), "/", -1)


def ani_edges(spark: SparkSession, path) -> DataFrame:
    """(a, b, score, fa, fb, ord) of an edge table by place; rows with fewer than five fields or no numbers are skipped."""
    rows = _tsv(spark, path, "a string, b string, ani string, fa string, fb string, an string, bn string")
    n = [F.col(c).try_cast("double").alias(o) for c, o in (("ani", "score"), ("fa", "fa"), ("fb", "fb"))]
    return rows.select(_base("a").alias("a"), _base("b").alias("b"), *n, F.monotonically_increasing_id().alias("ord")).dropna(subset=["score", "fa", "fb"])


def pairwise(spark: SparkSession, path) -> DataFrame:
    """A comma-separated table of compared pairs with query_name, match_name and jaccard."""
    return _tsv(spark, path, sep=",").select(F.col("query_name").alias("a"), F.col("match_name").alias("b"), F.col("jaccard").try_cast("double").alias("s"))


def pair_clusters(spark: SparkSession, path) -> DataFrame:
    """(representative, member) of a headerless two-column cluster list, base names."""
    return _tsv(spark, path, "r string, m string", header=False).where("m is not null").select(_base("r").alias("representative"), _base("m").alias("member"))


def cluster_table(spark: SparkSession, path) -> DataFrame:
    """(genome, cluster): the secondary cluster if the table has one, else the cluster."""
    raw = _tsv(spark, path, sep=",")
    cols = [F.nullif(F.trim(c), F.lit("")) for c in ("secondary_cluster", "cluster") if c in raw.columns]
    return raw.select(F.trim("genome").alias("genome"), F.coalesce(*cols).alias("cluster")).where("cluster is not null")


def quality(spark: SparkSession, path) -> DataFrame:
    """(genome, completeness, contamination, length, n50, centrality) of a table of seven or five columns; what is absent or no number is 0."""
    raw = _tsv(spark, path, sep=",")
    names = {"completeness": "completeness", "contamination": "contamination", "length": "length", "N50": "n50", "centrality": "centrality"}
    return raw.select(
        F.trim("genome").alias("genome"),
        *((F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in raw.columns else F.lit(0.0)).alias(o) for c, o in names.items()),
    )


def quality_text(spark: SparkSession, path) -> DataFrame:
    """The same table as text with all seven columns; what is absent or blank is NA."""
    raw = _tsv(spark, path, sep=",")
    have = {"genome": "genome", "completeness": "completeness", "contamination": "contamination", "length": "length", "N50": "n50", "centrality": "centrality"}
    return raw.select(*((F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("NA")) if c in raw.columns else F.lit("NA")).alias(o) for c, o in have.items()))


def archive_rows(spark: SparkSession, path) -> DataFrame:
    """(archive, n, fields): the lines of the first .tsv or .tsv.gz file in each tar archive, packed or not, as arrays of fields.

    An archive is a stream and is read by one task, line by line; one without such a file is an error when it is read.
    """
    import gzip
    import io
    import tarfile

    import pyarrow as pa

    def run(batches):
        for b in batches:
            for name, body in zip(b.column(0).to_pylist(), b.column(1)):
                with tarfile.open(fileobj=io.BytesIO(body.as_buffer()), mode="r:*") as tar:
                    member = next((m for m in tar if m.isfile() and m.name.endswith((".tsv", ".tsv.gz"))), None)
                    if member is None:
                        raise ValueError(f"no .tsv file in {name}")
                    lines = tar.extractfile(member)
                    lines = gzip.open(lines) if member.name.endswith(".gz") else lines
                    n, held = 0, []
                    for line in io.TextIOWrapper(lines, "utf-8"):
                        held.append(line.rstrip("\r\n").split("\t"))
                        if len(held) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(range(n, n + len(held)), pa.int64()), pa.array(held)], ["archive", "n", "fields"])
                            n, held = n + len(held), []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(range(n, n + len(held)), pa.int64()), pa.array(held)], ["archive", "n", "fields"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, n bigint, fields array<string>")


def archive_table(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """The named columns of the table in each archive, found by its first line; a column it lacks is null."""
    from ..session import cut

    rows = cut(archive_rows(spark, path))
    heads = rows.where("n = 0").select("archive", F.col("fields").alias("_h"))
    body = rows.where("n > 0").join(F.broadcast(heads), "archive")
    return body.select(*(F.try_element_at("fields", F.nullif(F.array_position("_h", F.lit(c)).cast("int"), F.lit(0))).alias(c) for c in columns))


def read_records(spark: SparkSession, path, schema: str) -> DataFrame:
    """Records of JSON files, each one object a line or one array over all lines; files are told apart by their first sign."""
    lines = spark.read.text(path).where("trim(value) != ''")
    first = lines.limit(1).collect()
    whole = bool(first) and first[0][0].lstrip().startswith("[")
    return spark.read.schema(schema).option("multiLine", whole).json(path)


def similarities(spark: SparkSession, path) -> DataFrame:
    """(a, b, s) of an all-against-all table."""
    return _tsv(spark, path, sep=",").select(F.col("genome1").alias("a"), F.col("genome2").alias("b"), F.col("similarity").try_cast("double").alias("s"))


def length_table(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, "taxid string, name string, num bigint, seq_min bigint, seq_max bigint, seq_med bigint, seq_mean bigint, description string")


def lineage_table(spark: SparkSession, path, ranks: list[str]) -> DataFrame:
    """(taxid, name, num_with_tag, level, level_name, level_taxid) from the wide table of rank names and rank ids."""
    cols = ["taxid", "name", "num_with_tag", *ranks, *(f"{r}_taxid" for r in ranks)]
    raw = _tsv(spark, path, ", ".join(f"`{c}` string" for c in cols)).where(F.col(cols[-1]).isNotNull() | F.col(ranks[0]).isNotNull())
    pairs = F.explode(F.array(*(F.struct(F.lit(r).alias("level"), F.col(r).alias("level_name"), F.col(f"{r}_taxid").alias("level_taxid")) for r in ranks)))
    return raw.select("taxid", "name", "num_with_tag", pairs.alias("x")).select("taxid", "name", "num_with_tag", "x.*").where("level_name != ''")


def name_list(spark: SparkSession, path) -> DataFrame:
    """(path): lines of a list, padding and blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path != ''")


def taxon_pages(spark: SparkSession, path) -> DataFrame:
    """(taxid, name, rank, aka, lineage array of (taxid, name, rank)) of taxon pages in XML.

    A page whose root is not the set of taxa, such as a server's error page, is an error when it is read.
    """
    one = "TaxId: STRING, ScientificName: STRING, Rank: STRING"
    schema = f"Taxon ARRAY<STRUCT<{one}, AkaTaxIds: STRUCT<TaxId: ARRAY<STRING>>, LineageEx: STRUCT<Taxon: ARRAY<STRUCT<{one}>>>>>"
    pages = spark.read.text(path, wholetext=True)
    root = F.regexp_extract("value", r"(?s)^\s*(?:<[?!][^>]*>\s*)*<([A-Za-z]+)", 1)
    page = F.when(root == "TaxaSet", F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no page of taxa; its root is "), F.nullif(root, F.lit("")))))
    raw = pages.select(F.from_xml(page, schema).alias("x")).select("x.*")
    t = raw.select(F.explode("Taxon").alias("t"))
    return t.select(F.col("t.TaxId").alias("taxid"), F.col("t.ScientificName").alias("name"), F.col("t.Rank").alias("rank"), F.col("t.AkaTaxIds.TaxId").alias("aka"), F.transform("t.LineageEx.Taxon", lambda x: F.struct(x["TaxId"].alias("taxid"), x["ScientificName"].alias("name"), x["Rank"].alias("rank"))).alias("lineage"))


def accessions(names: DataFrame, column: str) -> DataFrame:
    return names.select(accession_of(F.col(column)).alias("accession")).dropna().distinct()
