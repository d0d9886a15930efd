"""Readers of sequence, alignment, annotation and matrix files into typed tables.

Line formats use Spark's splittable text reader (gz and bz2 by suffix).  FASTQ is read so
too: records are framed within each split, and the lines at its edges are put together after.
Only BAM and reports with state across lines read a file as one task's stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column layouts of the file formats.
SAM = ("read_id", "flag", "ref", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
NCBI_HITS = ("query", "subject", "pident", "length", "mismatch", "gapopen", "qs", "qe", "ss", "se", "evalue", "bits")
WU_HITS = {"query": 0, "subject": 1, "evalue": 2, "bits": 4, "pident": 10, "ppos": 11, "qs": 17, "qe": 18, "ss": 20, "se": 21}
TAXONOMY = ("taxaid", "kingdom", "phylum", "class", "order", "family", "genus", "species", "specI_cluster", "length")
MARKERS = ("gene", "length", "cog", "otu")
GENES = ("gene", "strand", "start", "stop", "length", "start_codon", "stop_codon", "gene_type")
GFF = ("seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attribute")
STATS = ("reads", "bases", "max", "avg", "kmer", "inserts", "min_identity", "min_length", "max_mismatches")


def lines(spark: SparkSession, path, comment: str | None = None) -> DataFrame:
    rows = spark.read.text(path)
    return rows.where(~F.col("value").startswith(comment)) if comment else rows


def _fields(rows: DataFrame, names, sep: str = "\t") -> DataFrame:
    cells = F.split("value", sep)
    return rows.select(*[F.get(cells, F.lit(n)).alias(name) for n, name in enumerate(names)])


def _numbers(rows: DataFrame, **kinds: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def read_fastq(spark: SparkSession, path) -> DataFrame:
    """header, seq, qual and file; sequence and quality of unequal length, and a broken record, raise an error.

    Large plain and bz2 files are read in splits, a gz file as one stream; no file is held
    whole.  Within a split the first record is found by its form (a line with @, two on one
    with +, lines of equal length between and after); the lines before it and the unfinished
    record at the end are joined with those of the neighbouring splits.
    """
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    schema = "header string, seq string, qual string, file string, at long, place int, edge array<string>"
    framed = rows.mapInArrow(_frame, schema)
    whole = framed.where("edge is null").select("header", "seq", "qual", "file")
    # a file's edges: a few lines a split, in order; a record begins in an end piece (place 2) and goes on to the next one
    from pyspark.sql import Window

    edges = framed.where("edge is not null").select("file", "at", "place", "edge")
    order = Window.partitionBy("file").orderBy("at", "place")
    edges = edges.withColumn("part", F.sum(F.when(F.col("place") == 2, 1).otherwise(0)).over(order))
    pieces = edges.groupBy("file", "part").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "place", "edge"))), lambda x: x["edge"])).alias("lines"))
    n = F.size("lines")
    bad = F.raise_error(F.concat("file", F.lit(" ends within a record")))
    pieces = pieces.where(n > 0).withColumn("lines", F.when(n % 4 != 0, bad.cast("array<string>")).otherwise(F.col("lines")))
    records = pieces.select("file", "lines", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / 4).cast("int"))).alias("k"))
    line = lambda d: F.get("lines", 4 * F.col("k") + d)
    odd = F.raise_error(F.concat(F.lit("sequence and quality differ in length: "), line(0))).cast("string")
    records = records.select(F.substring(line(0), F.lit(2), F.length(line(0))).alias("header"), F.when(F.length(line(1)) == F.length(line(3)), line(1)).otherwise(odd).alias("seq"), line(3).alias("qual"), "file")
    return whole.unionByName(records)


def _frame(batches):
    """Records of each split, and its edges as lists of lines: place 0 before the first record, 2 after the last."""
    import pyarrow as pa

    names = ["header", "seq", "qual", "file", "at", "place", "edge"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string())]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def first_record(lines):
        for p in range(min(4, len(lines) - 3)):
            if lines[p].startswith("@") and lines[p + 2].startswith("+") and len(lines[p + 1]) == len(lines[p + 3]) and (len(lines) <= p + 4 or lines[p + 4].startswith("@")):
                return p
        return None

    here, held, framed = None, [], False

    def take(out):
        while len(held) >= 4:
            header, seq, plus, qual = held[:4]
            if not header.startswith("@") or not plus.startswith("+"):
                raise ValueError(f"{here[0]}: no record at {header[:60]}")
            if len(seq) != len(qual):
                raise ValueError(f"sequence and quality differ in length: {header}")
            out.append((header[1:], seq, qual, *here, None, None))
            del held[:4]

    def end(out):
        if framed:
            out.append((None, None, None, *here, 2, list(held)))
        elif held:
            p = first_record(held) if len(held) < 8 else None
            out.append((None, None, None, *here, 0, held[: p if p is not None else len(held)]))
            if p is not None:
                del held[:p]
                take(out)
                out.append((None, None, None, *here, 2, list(held)))
        held.clear()

    for batch in batches:
        out = []
        for value, file, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if here != (file, at):
                if here is not None:
                    end(out)
                here, framed = (file, at), at == 0
            held.append(value.rstrip("\r"))
            if not framed and len(held) == 8:
                p = first_record(held)
                if p is None:
                    raise ValueError(f"{file}: no record found at {at}")
                out.append((None, None, None, *here, 0, held[:p]))
                del held[:p]
                framed = True
            if framed and len(held) >= 4:
                take(out)
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)
    if here is not None:
        out = []
        end(out)
        if out:
            yield batch_of(out)


def _text_lines(stream, size: int = 1 << 20):
    rest = b""
    while block := stream.read(size):
        parts = (rest + block).split(b"\n")
        rest = parts.pop()
        yield from (p.rstrip(b"\r").decode() for p in parts)
    if rest:
        yield rest.rstrip(b"\r").decode()


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """seq_id (up to white space), description and sequence."""
    rows = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    head = F.regexp_extract("value", "^([^\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace("value", "^[^\n]*\n?", ""), "[\\s]", "")
    return rows.select(F.regexp_extract(head, r"^(\S+)", 1).alias("seq_id"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), seq.alias("seq"))


def read_soap(spark: SparkSession, path) -> DataFrame:
    """SOAP alignments; the CIGAR and mismatch string are the last two of a varying number of fields."""
    cells = F.split("value", "\t")
    names = {"read_id": 0, "seq": 1, "qual": 2, "n_hits": 3, "length": 5, "strand": 6, "ref": 7, "pos": 8}
    rows = lines(spark, path).select(*[F.get(cells, F.lit(n)).alias(c) for c, n in names.items()], F.element_at(cells, -2).alias("cigar"), F.element_at(cells, -1).alias("md"))
    return _numbers(rows, n_hits="int", length="int", pos="long")


def read_sam(spark: SparkSession, path) -> DataFrame:
    """SAM alignments with optional tags as a map; header lines are skipped."""
    cells = F.split("value", "\t")
    rows = lines(spark, path, "@").select(*[F.get(cells, F.lit(n)).alias(c) for n, c in enumerate(SAM)], F.slice(cells, F.lit(12), F.greatest(F.size(cells) - 11, F.lit(0))).alias("extra"))
    tags = F.map_from_entries(F.transform("extra", lambda f: F.struct(F.split(f, ":", 3)[0], F.split(f, ":", 3)[2])))
    return _numbers(rows.withColumn("tags", tags).drop("extra"), flag="int", pos="long", mapq="int", pnext="long", tlen="long")


def read_coordinates(spark: SparkSession, path) -> DataFrame:
    """ref, idx, start, stop; intervals of a reference are numbered by place."""
    from pyspark.sql import Window

    rows = _numbers(_fields(lines(spark, path).where(F.col("value").rlike(r"^[^\t]+\t\d+\t\d+")), ("ref", "start", "stop")), start="long", stop="long")
    return rows.withColumn("idx", F.row_number().over(Window.partitionBy("ref").orderBy("start", "stop")) - 1).select("ref", "idx", "start", "stop")


def read_taxonomy(spark: SparkSession, path) -> DataFrame:
    rows = lines(spark, path, "#")
    wrong = F.size(F.split("value", "\t")) != len(TAXONOMY)
    rows = rows.select(F.when(wrong, F.raise_error(F.concat(F.lit("a taxonomy line has ten fields: "), "value"))).otherwise(F.col("value")).alias("value"))
    return _numbers(_fields(rows, TAXONOMY), length="double")


def read_markers(spark: SparkSession, path) -> DataFrame:
    return _numbers(_fields(lines(spark, path), MARKERS), length="long")


def read_functional_map(spark: SparkSession, path) -> DataFrame:
    """(gene, level, cell): the header line, one line of the file, names the levels."""
    header = spark.read.text(path).where(F.col("value").startswith("#")).first()[0].lstrip("#").split("\t")
    rows = _fields(lines(spark, path, "#"), ["gene", *header[1:]])
    return rows.unpivot("gene", header[1:], "level", "cell")


def read_stats(spark: SparkSession, path, missing_ok: bool = False) -> DataFrame:
    """Read statistics by position; with ``missing_ok`` a file that is not there gives a row of zeros and a note."""
    kinds = {"reads": "long", "bases": "long", "max": "int", "avg": "double", "kmer": "int", "inserts": "long"}
    if missing_ok:
        place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
        if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return spark.range(1).select(*[F.lit("0").cast(kinds.get(c, "string")).alias(c) for c in STATS], F.lit(f"missing: {path}").alias("note"))
    rows = _numbers(_fields(lines(spark, path).where(~F.col("value").startswith("Reads")), STATS), **kinds)
    return rows.withColumn("note", F.lit(None).cast("string")) if missing_ok else rows


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Tabular search hits of either flavour, told apart by their number of fields; columns a flavour lacks are null."""
    cells = F.split("value", "\t")
    ncbi = F.size(cells) == 12
    place = {c: n for n, c in enumerate(NCBI_HITS)}
    names = [*WU_HITS, *[c for c in NCBI_HITS if c not in WU_HITS]]
    cell = lambda where, c: F.get(cells, F.lit(where[c])) if c in where else F.lit(None).cast("string")
    rows = lines(spark, path, "#").select(*[F.when(ncbi, cell(place, c)).otherwise(cell(WU_HITS, c)).alias(c) for c in names])
    return _numbers(rows, evalue="double", bits="double", pident="double", ppos="double", qs="long", qe="long", ss="long", se="long", length="long", mismatch="long", gapopen="long")


def read_gene_headers(spark: SparkSession, path) -> DataFrame:
    """Gene table from predicted genes' FASTA headers: name # start # stop # strand # key=value;..."""
    rows = lines(spark, path).where(F.col("value").startswith(">"))
    parts = F.split(F.substring("value", 2, 1 << 30), " # ")
    attributes = F.str_to_map(F.get(parts, F.lit(4)), F.lit(";"), F.lit("="))
    partial = F.element_at(attributes, "partial")
    kind = F.when(partial == "00", "complete").when(partial == "11", "internal").otherwise("incomplete")
    start, stop = F.get(parts, F.lit(1)).cast("long"), F.get(parts, F.lit(2)).cast("long")
    return rows.select(F.get(parts, F.lit(0)).alias("gene"), F.when(F.get(parts, F.lit(3)) == "1", "+").otherwise("-").alias("strand"), start.alias("start"), stop.alias("stop"), (stop - start + 1).alias("length"), F.element_at(attributes, "start_type").alias("start_codon"), kind.alias("gene_type"))


def read_domains(spark: SparkSession, path, least_bits: float = 0) -> DataFrame:
    """Domain search table: target, taxid (before the first dot), project, query, bits."""
    cells = F.split(F.trim("value"), r"\s+")
    rows = lines(spark, path, "#").select(F.get(cells, F.lit(0)).alias("target"), F.get(cells, F.lit(3)).alias("query"), F.get(cells, F.lit(7)).cast("double").alias("bits"))
    return rows.where(F.col("bits") >= least_bits).withColumn("taxid", F.substring_index("target", ".", 1)).withColumn("project", F.get(F.split("target", r"\."), F.lit(1)))


def read_gff(spark: SparkSession, path) -> DataFrame:
    rows = _numbers(_fields(lines(spark, path, "#").where("value <> ''"), GFF), start="long", end="long")
    pairs = F.filter(F.split("attribute", r"\s*;\s*"), lambda a: a != "")
    entry = F.transform(pairs, lambda a: F.struct(F.regexp_extract(a, r"^([^ =]+)", 1), F.trim(F.regexp_replace(F.regexp_replace(a, r"^[^ =]+[ =]?", ""), '"', ""))))
    return rows.withColumn("attributes", F.map_from_entries(entry))


def read_matrix(spark: SparkSession, path, missing: tuple[str, ...] = ("NA", "")) -> DataFrame:
    """A feature-by-sample table with a header line, in long form; # lines are comments."""
    header = spark.read.text(path).where(~F.col("value").startswith("#")).first()[0].split("\t")
    names = header[1:] if header[0] == "" or len(header) > 1 else header
    head = "\t".join(header)
    rows = _fields(lines(spark, path, "#").where(F.col("value") != head), ["feature", *names])
    rows = rows.unpivot("feature", names, "sample", "value")
    return rows.withColumn("value", F.when(~F.col("value").isin(*missing), F.col("value").cast("double")))


def read_cells(spark: SparkSession, path) -> DataFrame:
    """Three-column matrices: feature, sample, value."""
    return _numbers(_fields(lines(spark, path, "#"), ("feature", "sample", "value")), value="double")


def read_lower_triangle(spark: SparkSession, path) -> DataFrame:
    """A lower-triangle distance file (a count, then a name and distances a line), mirrored, with a zero diagonal."""
    cells = F.split(F.trim("value"), r"\s+")
    rows = lines(spark, path).where(~F.col("value").rlike(r"^\s*\d+\s*$")).select(F.get(cells, F.lit(0)).alias("a"), F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))).alias("d"))
    rows = rows.withColumn("nth", F.size("d"))
    pairs = rows.select("a", F.posexplode("d").alias("at", "value")).join(rows.select(F.col("a").alias("b"), F.col("nth").alias("at")), "at")
    pairs = pairs.select("a", "b", F.col("value").cast("double"))
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "value")).unionByName(rows.select("a", F.col("a").alias("b"), F.lit(0.0).alias("value")))


def read_samples(spark: SparkSession, path) -> DataFrame:
    return lines(spark, path, "#").select(F.trim("value").alias("sample")).where("sample <> ''")


def read_gene_report(spark: SparkSession, path) -> DataFrame:
    """contig, gene, strand, start, stop, length, class of a gene finder's report; a header names each contig's table.

    The contig a line belongs to stands above it, so a file is read in order by one task.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows, contig = [], None
            for content in batch.column("content"):
                for line in _text_lines(pa.BufferReader(content.as_buffer())):
                    if line.startswith("FASTA definition line:"):
                        contig = line.split(":", 1)[1].strip().lstrip(">")
                    cells = line.split()
                    if len(cells) >= 5 and cells[0].isdigit() and cells[1] in "+-" and contig is not None:
                        start, stop = (int(c.lstrip("<>")) for c in cells[2:4])
                        rows.append((contig, f"{contig}_{cells[0]}", cells[1], start, stop, int(cells[4]), cells[5] if len(cells) > 5 else None))
            if rows:
                kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["contig", "gene", "strand", "start", "stop", "length", "class"])

    schema = "contig string, gene string, strand string, start long, stop long, length long, class string"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_features(spark: SparkSession, path, key: str = "ID") -> DataFrame:
    """GFF features, lines of one feature and identifier as one with all its locations in order of place."""
    rows = read_gff(spark, path).withColumn("name", F.coalesce(F.element_at("attributes", key), F.element_at("attributes", "gene_id")))
    alone = F.coalesce("name", F.concat_ws(":", "seqname", "start", "end", "feature"))
    return rows.groupBy("seqname", "feature", "strand", alone.alias("name")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("locations"))


def read_pairs(spark: SparkSession, path) -> DataFrame:
    """Two-column files: key, value."""
    return _numbers(_fields(lines(spark, path, "#"), ("key", "value")), value="double")


def read_columns(spark: SparkSession, path, names: list[str], missing: tuple[str, ...] = ("NA", "")) -> DataFrame:
    """Files of a feature and one value a named column, without a header, in long form."""
    rows = _fields(lines(spark, path, "#"), ["feature", *names]).unpivot("feature", names, "sample", "value")
    return rows.withColumn("value", F.when(~F.col("value").isin(*missing), F.col("value").cast("double")))


def read_bam(spark: SparkSession, path) -> DataFrame:
    """Alignments of BAM files in the columns of ``read_sam``; a file (up to 2 GB, Spark's bound for a binary value) is one task's stream."""
    import pyarrow as pa

    names = [*SAM, "tags"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string())]

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                out = []
                with pa.CompressedInputStream(pa.BufferReader(content.as_buffer()), "gzip") as stream:
                    for row in _bam_rows(stream):
                        out.append(row)
                        if len(out) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "read_id string, flag int, ref string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


#: The codes of the binary alignment format.
BAM_OPERATIONS, BAM_BASES, BAM_NUMBERS = "MIDNSHP=X", "=ACMGRSVTWYHKDBN", {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def _bam_rows(stream):
    """Rows of an unpacked BAM stream."""
    import struct

    def read(n):
        data = b""
        while len(data) < n and (more := stream.read(n - len(data))):
            data += more
        return data

    if read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    read(struct.unpack("<i", read(4))[0])
    refs = []
    for _ in range(struct.unpack("<i", read(4))[0]):
        refs.append(read(struct.unpack("<i", read(4))[0])[:-1].decode())
        read(4)
    while size := read(4):
        block = read(struct.unpack("<i", size)[0])
        ref, pos, name_size, mapq, _, n_ops, flag, length, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", block)
        at = 32 + name_size
        name = block[32 : at - 1].decode()
        ops = struct.unpack_from(f"<{n_ops}I", block, at)
        at += 4 * n_ops
        packed = block[at : at + (length + 1) // 2]
        at += (length + 1) // 2
        seq = "".join(BAM_BASES[b >> 4] + BAM_BASES[b & 15] for b in packed)[:length] or "*"
        raw = block[at : at + length]
        at += length
        tags = {}
        while at + 3 <= len(block):
            key, kind = block[at : at + 2].decode(), chr(block[at + 2])
            at += 3
            if kind in "ZH":
                stop = block.index(b"\0", at)
                tags[key], at = block[at:stop].decode(), stop + 1
            elif kind == "A":
                tags[key], at = chr(block[at]), at + 1
            elif kind == "B":
                form = BAM_NUMBERS[chr(block[at])]
                n = struct.unpack_from("<i", block, at + 1)[0]
                tags[key] = ",".join([chr(block[at]), *map(str, struct.unpack_from(f"<{n}{form}", block, at + 5))])
                at += 5 + n * struct.calcsize(form)
            else:
                form = BAM_NUMBERS[kind]
                tags[key] = str(struct.unpack_from(f"<{form}", block, at)[0])
                at += struct.calcsize(form)
        where = lambda r: refs[r] if r >= 0 else "*"
        yield (
            name, flag, where(ref), pos + 1, mapq, "".join(f"{o >> 4}{BAM_OPERATIONS[o & 15]}" for o in ops) or "*", "=" if next_ref == ref >= 0 else where(next_ref), next_pos + 1, tlen, seq,
            "*" if not raw or raw[0] == 255 else "".join(chr(b + 33) for b in raw), list(tags.items()))
