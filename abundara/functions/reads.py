"""Scalar functions on reads, alignments and sequences, all as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_read_id(read: Column) -> tuple[Column, Column]:
    """insert and mate of ``insert/1`` or ``insert/2``; anything else raises an error."""
    ok = read.rlike("^.+/[12]$")
    insert = F.when(ok, F.regexp_extract(read, "^(.+)/([12])$", 1)).otherwise(F.raise_error(F.concat(F.lit("not a mate id: "), read)))
    return insert, F.regexp_extract(read, "^(.+)/([12])$", 2).cast("int")


def cigar_ops(cigar: Column) -> Column:
    """A CIGAR string as an array of (len, op)."""
    lens = F.regexp_extract_all(cigar, F.lit("([0-9]+)[A-Z=]"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit("[0-9]+([A-Z=])"), F.lit(1))
    return F.zip_with(lens, ops, lambda n, o: F.struct(n.cast("long").alias("len"), o.alias("op")))


def cigar_project(cigar: Column, pos: Column) -> Column:
    """(match_len, total_len, first_base, last_base).

    Clips and insertions before the first match shift the alignment's start; insertions
    between matches count once the next match follows; deletions do not count; a clip at
    the end adds to total_len only.  Other operations raise an error.
    """
    zero = F.lit(0).cast("long")

    def step(a: Column, x: Column) -> Column:
        op, n = x["op"], x["len"]
        started = a["match"] > 0
        match = F.when(op.isin("M", "="), a["match"] + a["held"] + n).otherwise(a["match"])
        held = F.when(op.isin("M", "="), zero).when((op == "I") & started, a["held"] + n).otherwise(a["held"])
        offset = F.when(~started & op.isin("H", "S", "I"), a["offset"] + n).otherwise(a["offset"])
        tail = F.when(started & op.isin("H", "S"), a["tail"] + n).otherwise(a["tail"])
        bad = ~op.isin("M", "=", "I", "D", "H", "S")
        match = F.when(bad, F.raise_error(F.concat(F.lit("unsupported CIGAR operation "), op)).cast("long")).otherwise(match)
        return F.struct(match.alias("match"), held.alias("held"), offset.alias("offset"), tail.alias("tail"))

    start = F.struct(zero.alias("match"), zero.alias("held"), zero.alias("offset"), zero.alias("tail"))
    return F.aggregate(cigar_ops(cigar), start, step, lambda a: F.struct(
        a["match"].alias("match_len"), (a["match"] + a["offset"] + a["tail"]).alias("total_len"),
        (pos + a["offset"]).alias("first_base"), (pos + a["offset"] + a["match"] - 1).alias("last_base")))


def mismatches(marks: Column, any_letter: bool = False) -> Column:
    """Letters of a mismatch string: bases only, or any letter."""
    return F.length(F.regexp_replace(marks, "[^A-Za-z]" if any_letter else "[^ACGT]", ""))


def identity(mismatch: Column, length: Column) -> Column:
    return 100 - mismatch / length * 100


def mapping_quality(identity_: Column) -> Column:
    return (identity_ * 10).cast("int")


def tags(fields: Column) -> Column:
    """Optional KEY:TYPE:VALUE fields as a map."""
    return F.map_from_entries(F.transform(fields, lambda f: F.struct(F.split(f, ":", 3)[0], F.split(f, ":", 3)[2])))


def overlap(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Signed overlap of two hits, negative when apart (ends not counted twice)."""
    return F.least(end2 - start1, end1 - start2)


def overlap_share(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Shared length over the shorter interval."""
    return F.greatest(F.lit(0), F.least(end1, end2) - F.greatest(start1, start2)) / F.least(end1 - start1, end2 - start2)


def kmer_size(bases: Column, reads: Column) -> Column:
    """Odd k near half the mean read length."""
    mean = F.floor(bases / reads + 0.5)
    half = F.floor(mean / 2)
    even = F.when(half % 2 == 0, half + 1).otherwise(half + 2)
    up = F.floor((mean + 1) / 2)
    return F.when(mean % 2 == 0, even).otherwise(F.when(up % 2 == 0, up + 1).otherwise(up)).cast("long")


def nearest_multiple(x: Column, step: float) -> Column:
    return F.round(x / step) * step


def read_stem(header: Column) -> Column:
    """A FASTQ header without its mate, the same for both mates; null for reads to drop.

    A slash before the last character ends the stem.  Headers of eleven fields (split at colons
    and spaces) have their mate field set to 0; they are dropped if marked as filtered, or if
    their mate is neither 1 nor 2.  Headers of six or seven fields keep the first and the third
    to sixth.  Others stay; spaces become underscores.
    """
    parts = F.split(header, "[: ]", -1)
    part = lambda n: F.get(parts, F.lit(n))
    slash = F.locate("/", header) == F.length(header) - 1
    long_ = F.concat_ws(":", F.slice(parts, 1, 7), F.lit("0"), F.slice(parts, 9, 3))
    return (
        F.when(slash, F.replace(F.substring(header, F.lit(1), F.length(header) - 2), F.lit(" "), F.lit("_")))
        .when(F.size(parts) == 11, F.when((part(8) != "Y") & part(7).isin("1", "2"), long_))
        .when(F.size(parts).isin(6, 7), F.concat(F.concat_ws(":", part(0), part(2), part(3), part(4), part(5)), F.lit("#0")))
        .otherwise(F.replace(header, F.lit(" "), F.lit("_")))
    )


def optional_tag(fields: Column, tag: str, first: int | None = None, last: int | None = None) -> Column:
    """Absolute value of an optional KEY:TYPE:VALUE field of a line's cells, looked for in the columns ``first`` to ``last`` (from 0) only."""
    some = fields if first is None else F.slice(fields, F.lit(first + 1), F.lit(last - first + 1))
    found = F.filter(some, lambda f: f.startswith(f"{tag}:"))
    return F.abs(F.element_at(F.split(F.get(found, F.lit(0)), ":", 3), 3).cast("double"))


def log_shift(x: Column, shift: float) -> Column:
    """Logarithm to base 10 with a pseudocount."""
    return F.log10(x + shift)


def arcsine_root(x: Column) -> Column:
    return F.asin(F.sqrt(x))


def cell_set(cell: Column, outer: str = "[|]", inner: str | None = None) -> Column:
    """The distinct values of a multi-value cell, sorted; with ``inner`` each value's own parts as a list (sub-columns)."""
    values = F.array_sort(F.array_distinct(F.filter(F.split(cell, outer), lambda v: v != "")))
    return values if inner is None else F.transform(values, lambda v: F.split(v, inner))


def joined_cells(cells: Column, sep: str = "|") -> Column:
    """Multi-value cells of a group as one: the sorted set of all their values."""
    return F.concat_ws(sep, F.array_sort(F.array_distinct(F.flatten(F.collect_list(cells)))))


def scaftigs(name: Column, sequence: Column, least: int) -> Column:
    """Maximal runs of bases of at least ``least``, numbered among those kept."""
    runs = F.filter(F.regexp_extract_all(sequence, F.lit("[ATGCatgc]+"), F.lit(0)), lambda s: F.length(s) >= least)
    return F.transform(runs, lambda s, i: F.struct(F.concat_ws("_", name, (i + 1).cast("string")).alias("id"), s.alias("seq")))


def reverse_complement(sequence: Column) -> Column:
    return F.translate(F.reverse(sequence), "ACGTacgt", "TGCAtgca")


def wrap(sequence: Column, width: int = 60) -> Column:
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")


def fasta_to_tab(definition: Column, sequence: Column) -> Column:
    return F.concat_ws("\t", F.regexp_replace(definition, "\t", " "), F.regexp_replace(sequence, " ", ""))


def padded(start: Column, stop: Column, pad: int = 100) -> tuple[Column, Column, Column, Column]:
    """Padded start and stop, and the gene's place within."""
    new = F.greatest(F.lit(1), start - pad)
    return new, stop + pad, start - new + 1, stop - new + 1


def trim_tail(quality: Column, sequence: Column, *, offset: int, least_quality: int, least_length: int, least_percent: int) -> Column:
    """Cut low-quality bases off the end; null if too short or too few good bases (whole percent) are left."""
    good = F.transform(F.split(quality, ""), lambda c: F.ascii(c) - offset)
    good = F.filter(good, lambda q: q > -offset)
    length = F.coalesce(F.array_max(F.transform(good, lambda q, i: F.when(q >= least_quality, i + 1))), F.lit(0))
    kept = F.slice(good, F.lit(1), length)
    percent = F.floor(100 * F.size(F.filter(kept, lambda q: q >= least_quality)) / F.greatest(length, F.lit(1)))
    out = F.struct(F.substring(sequence, F.lit(1), length).alias("seq"), F.substring(quality, F.lit(1), length).alias("qual"))
    return F.when((length >= least_length) & (percent >= least_percent), out)


def trim_longest(quality: Column, sequence: Column, *, offset: int, least_quality: int, least_length: int) -> Column:
    """The first longest run of bases above a quality; null if too short."""
    good = F.filter(F.transform(F.split(quality, ""), lambda c: F.ascii(c) - offset), lambda q: q > -offset)
    i0 = F.lit(0)
    start = F.struct(i0.alias("at"), i0.alias("run"), i0.alias("best"), i0.alias("end"))

    def step(a: Column, q: Column) -> Column:
        run = F.when(q > least_quality, a["run"] + 1).otherwise(0)
        return F.struct((a["at"] + 1).alias("at"), run.alias("run"), F.greatest(a["best"], run).alias("best"), F.when(run > a["best"], a["at"] + 1).otherwise(a["end"]).alias("end"))

    found = F.aggregate(good, start, step)
    first = found["end"] - found["best"] + 1
    out = F.struct(F.substring(sequence, first, found["best"]).alias("seq"), F.substring(quality, first, found["best"]).alias("qual"))
    return F.when(found["best"] >= least_length, out)


def codon_table() -> dict[str, str]:
    """The standard genetic code, from its usual one-line form in TCAG order."""
    # Fixed value: the amino acids of the standard genetic code.
    amino = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
    return {a + b + c: amino[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}


def translate_codons(sequence: Column) -> Column:
    """Amino acids of a coding sequence, X where a codon is unknown."""
    table = F.create_map(*[F.lit(x) for pair in codon_table().items() for x in pair])
    return F.array_join(F.transform(codons(sequence), lambda c: F.coalesce(F.element_at(table, c), F.lit("X"))), "")


def synonymous_sites(codon: str) -> float:
    """Share of single-base changes, summed over the three places, that keep the amino acid."""
    table = codon_table()
    return sum(table[codon[:i] + b + codon[i + 1 :]] == table[codon] for i in range(3) for b in "ACGT" if b != codon[i]) / 3


def codons(sequence: Column) -> Column:
    """Whole codons of a coding sequence in capitals; a rest of one or two bases is left out."""
    return F.regexp_extract_all(F.upper(sequence), F.lit("(?s).{3}"), F.lit(0))


def synonymous(first: Column, second: Column) -> Column:
    """Whether two codons stand for one amino acid; null if either is unknown."""
    table = F.create_map(*[F.lit(x) for pair in codon_table().items() for x in pair])
    return F.element_at(table, first) == F.element_at(table, second)


def site_counts(sequence: Column) -> tuple[Column, Column]:
    """Synonymous and non-synonymous sites of a coding sequence; unknown codons count as neither."""
    table = F.create_map(*[F.lit(x) for codon in codon_table() for x in (codon, synonymous_sites(codon))])
    known = F.filter(F.transform(codons(sequence), lambda c: F.element_at(table, c)), lambda x: x.isNotNull())
    same = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return same, 3.0 * F.size(known) - same


def mismatch_tag(marks: Column, length: Column) -> Column:
    """MD tag of a gapless alignment from comma-joined marks ``offset:base`` (offsets from 0, rising): matches between the reference bases."""
    cells = F.filter(F.split(F.coalesce(marks, F.lit("")), ","), lambda m: m != "")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(a: Column, m: Column) -> Column:
        at = F.split_part(m, F.lit(":"), F.lit(1)).cast("int")
        return F.struct((at + 1).alias("at"), F.concat(a["text"], (at - a["at"]).cast("string"), F.split_part(m, F.lit(":"), F.lit(2))).alias("text"))

    return F.aggregate(cells, start, step, lambda a: F.concat(a["text"], (length - a["at"]).cast("string")))


def scarf_fields(line: Column) -> Column:
    """(name, seq, qual) of a one-line record: name fields, sequence and qualities (characters, or numbers by spaces) by colons."""
    cells = F.split(line, ":", -1)
    n = F.size(cells)
    return F.struct(F.concat_ws(":", F.slice(cells, F.lit(1), n - 2)).alias("name"), F.element_at(cells, -2).alias("seq"), F.element_at(cells, -1).alias("qual"))


def integer_quality(numbers: Column, offset: int = 33) -> Column:
    """Quality characters of scores written as numbers by spaces."""
    return F.array_join(F.transform(F.filter(F.split(F.trim(numbers), r"\s+"), lambda x: x != ""), lambda x: F.char(x.cast("int") + offset)), "")


def phred_from_solexa(q: Column) -> Column:
    """Sanger quality character of a Solexa score."""
    return F.char(F.floor(33 + 10 * F.log10(1 + F.pow(F.lit(10.0), q / 10)) + 0.499).cast("int"))


def quality_format(lowest: Column, highest: Column) -> Column:
    """s: Sanger, x: Solexa, i: Illumina, from the range of quality characters seen."""
    return F.when(lowest < 59, "s").when(lowest < 64, "x").when(highest > 74, "i").otherwise("s")


def colour_trim(quality: Column, sequence: Column, allowed: str, least_length: int) -> Column:
    """Cut at the first quality outside a set of characters (a class body); null if too short."""
    n = F.length(F.regexp_extract(quality, f"^[{allowed}]*", 0))
    return F.when(n >= least_length, F.struct(F.substring(sequence, F.lit(1), n).alias("seq"), F.substring(quality, F.lit(1), n).alias("qual")))


def fasta_to_fastq(name: Column, sequence: Column, quality: str = "I") -> Column:
    return F.concat(F.lit("@"), name, F.lit("\n"), sequence, F.lit("\n+\n"), F.repeat(F.lit(quality), F.length(sequence)))


def fastq_to_fasta(name: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), sequence)


def sanger_quality(quality: Column, form: str) -> Column:
    """Quality characters in Sanger form from s (Sanger), i (offset 64) or x (Solexa scores, offset 64)."""
    if form == "s":
        return quality
    code = lambda c: F.ascii(c) - 64
    one = (lambda c: F.char(code(c) + 33)) if form == "i" else (lambda c: phred_from_solexa(code(c)))
    return F.array_join(F.transform(F.filter(F.split(quality, ""), lambda c: c != ""), one), "")


def mate_suffix(read: Column, mate: Column, keep_single: Column, sequence: Column) -> Column:
    """Reads named by insert and mate; reads not kept stand as a single N so that mates stay in step."""
    return F.struct(F.concat_ws("/", read, mate.cast("string")).alias("read_id"), F.when(keep_single, sequence).otherwise("N").alias("seq"))


def flag_mate(flag: Column) -> Column:
    """Mate digit of an alignment flag; null where the read is unmapped."""
    return F.when(flag.bitwiseAND(4) != 0, None).when(flag.bitwiseAND(128) != 0, 2).otherwise(1)
