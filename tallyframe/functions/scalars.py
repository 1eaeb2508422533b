"""Scalar expressions: identifiers, labels, sequences, coordinates, versions and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_number(x: Column) -> Column:
    """Without a trailing underscore and digits."""
    return F.regexp_replace(x, r"_\d+$", "")


def before_bar(x: Column) -> Column:
    return F.substring_index(x, "|", 1)


def after_bar(x: Column) -> Column:
    return F.substring_index(x, "|", -1)


def without_last_part(x: Column) -> Column:
    """Without the last underscore and what follows."""
    return F.regexp_replace(x, r"_[^_]*$", "")


def domain_of(x: Column, default: Column) -> Column:
    """What precedes the first double underscore; the default where there is none."""
    return F.when(F.instr(x, "__") > 0, F.substring_index(x, "__", 1)).otherwise(default)


def taxon_key(domain: Column, taxon: Column) -> Column:
    return F.when(domain != "", F.concat_ws("__", domain, taxon)).otherwise(taxon)


def normal_placeholder(x: Column) -> Column:
    """X__X_unclassified and X__X_other lose the repeated domain."""
    d = F.substring_index(x, "__", 1)
    return (
        F.when(x == F.concat(d, F.lit("__"), d, F.lit("_unclassified")), F.concat(d, F.lit("__unclassified")))
        .when(x == F.concat(d, F.lit("__"), d, F.lit("_other")), F.concat(d, F.lit("__other")))
        .otherwise(x)
    )


def fold_key(x: Column) -> Column:
    """The key to which a minor taxon folds: D__other for D__x and D_x, x_other for a bare x."""
    return (
        F.when(F.instr(x, "__") > 0, F.concat(F.substring_index(x, "__", 1), F.lit("__other")))
        .when(F.instr(x, "_") > 0, F.concat(F.substring_index(x, "_", 1), F.lit("__other")))
        .otherwise(F.concat(x, F.lit("_other")))
    )


def lineage_text(ranks: list[Column]) -> Column:
    """d_A;p_B;...: blank ranks are skipped."""
    letters = "dpcofgs"
    return F.concat_ws(";", *(F.when(F.trim(r) != "", F.concat(F.lit(f"{k}_"), r)) for k, r in zip(letters, ranks, strict=True)))


def padded_lineage(x: Column, sep: str = "|", ranks: int = 7) -> Column:
    parts = F.split(x, f"[{sep}]")
    return F.slice(F.concat(parts, F.array_repeat(F.lit(""), ranks)), 1, ranks)


def safe_name(x: Column, default: str = "unnamed") -> Column:
    """A file name: the unsafe characters and blanks as underscores, no runs, none at the ends."""
    flat = F.regexp_replace(F.regexp_replace(x, r"[<>:\"/\\|?*\s]", "_"), "_+", "_")
    bare = F.regexp_replace(flat, "^[_.]+|[_.]+$", "")
    return F.when(bare == "", F.lit(default)).otherwise(bare)


def slug(x: Column) -> Column:
    return F.regexp_replace(x, "[^A-Za-z0-9._-]+", "_")


def accession(x: Column) -> Column:
    """n.v of GCA_n.v and GCF_n.v however its parts are joined; null if there is none."""
    found = F.regexp_extract(x, r"GC[AF][-_](\d+)[-_.](\d+)", 1)
    return F.when(found != "", F.concat(found, F.lit("."), F.regexp_extract(x, r"GC[AF][-_](\d+)[-_.](\d+)", 2)))


def count_of(x: Column, chars: str) -> Column:
    """How many of the given characters x has."""
    return F.length(x) - F.length(F.translate(x, chars, ""))


def gc_percent(x: Column) -> Column:
    """Share of G and C in either case. Upper case is not taken first: it lengthens some letters."""
    return F.coalesce(F.try_divide(count_of(x, "GCgc") * 100.0, F.length(x)), F.lit(0.0))


def alphabet(x: Column) -> Column:
    """nucleotide or protein. Letters beyond the nucleotide codes mean protein; so do, in twelve or more telling characters, fewer than
    three of the four bases, and bases that make up less than half of them. N and - tell nothing; without telling characters nucleotide."""
    up = F.upper(F.coalesce(x, F.lit("")))
    telling = F.translate(up, "N-", "")
    n = F.length(telling)
    kinds = sum((F.contains(telling, F.lit(base)).cast("int") for base in "ACGT"), F.lit(0))
    protein = (F.translate(up, "ATCGRYSWKMBDHVN-", "") != "") | ((n >= 12) & (kinds < 3)) | (count_of(telling, "ACGT") * 2 < n)
    return F.when(protein, "protein").otherwise("nucleotide")


def stops_as_gaps(x: Column) -> Column:
    return F.translate(x, "*", "-")


def identity(query: Column, subject: Column) -> Column:
    """(matches, mismatches, gaps) of two aligned strings of one length."""
    both = F.zip_with(F.split(query, ""), F.split(subject, ""), lambda a, b: F.when((a == "-") | (b == "-"), "g").when(a == b, "m").otherwise("x"))
    n = lambda k: F.size(F.filter(both, lambda s: s == k))
    return F.struct(n("m").alias("matches"), n("x").alias("mismatches"), n("g").alias("gaps"))


def to_zero_based(start: Column, end: Column) -> Column:
    """Closed from 1 to half-open from 0; null where the interval is not valid."""
    return F.when((start >= 1) & (end >= start), F.struct((start - 1).alias("start"), end.alias("end")))


def to_one_based(start: Column, end: Column) -> Column:
    """Half-open from 0 to closed from 1; null where the interval is not valid."""
    return F.when((start >= 0) & (end > start), F.struct((start + 1).alias("start"), end.alias("end")))


def phase(offset: Column) -> Column:
    return F.pmod(F.lit(3) - F.pmod(offset, F.lit(3)), F.lit(3))


def coverage(start: Column, end: Column, length: Column) -> Column:
    return F.coalesce(F.try_divide((end - start + 1) * 1.0, length), F.lit(0.0))


def ratio_text(n: Column, total: Column) -> Column:
    return F.concat_ws("/", n.cast("string"), total.cast("string"))


def fixed_text(x: Column, digits: int) -> Column:
    """A number with at most three fixed digits: NaN as NaN, null as blank, a negative zero with its sign. The exact binary value is
    rounded, ties to even.

    The fraction is taken as two whole numbers of 32 bits, so that integers do the rounding; bits beyond 2 ** -64 only break ties.
    """
    if not 0 <= digits <= 3:
        raise ValueError("between 0 and 3 digits")
    v, word = F.abs(x.cast("double")), 1 << 32
    whole = F.floor(v).cast("long")
    upper = (v - F.floor(v)) * F.lit(float(word))
    lower = (upper - F.floor(upper)) * F.lit(float(word))
    low = F.floor(lower).cast("long") * 10**digits
    high = F.floor(upper).cast("long") * 10**digits + F.shiftright(low, 32)
    kept, rest, more = F.shiftright(high, 32), high.bitwiseAND(F.lit(word - 1)), (low.bitwiseAND(F.lit(word - 1)) > 0) | (lower > F.floor(lower))
    odd = F.pmod(kept if digits else whole, F.lit(2)) == 1
    half = rest == word // 2
    kept = kept + ((rest > word // 2) | (half & (more | odd))).cast("long")
    full = kept == 10**digits  # the fraction rounds up to 1
    text = F.concat(F.when(F.startswith(x.cast("double").cast("string"), F.lit("-")), "-").otherwise(""), (whole + full.cast("long")).cast("string"))
    if digits:
        text = F.concat(text, F.lit("."), F.lpad(F.when(full, 0).otherwise(kept).cast("string"), digits, "0"))
    return F.when(x.isNull(), "").when(F.isnan(x.cast("double")), "NaN").otherwise(text)


def only_numeric(x: Column, digits: int) -> Column:
    """Text that is a number, with fixed digits; other text as it is."""
    return F.when(x.rlike(r"^-?\d+(\.\d+)?$"), F.round(x.try_cast("decimal(38,12)"), digits).cast(f"decimal(38,{digits})").cast("string")).otherwise(x)


def version_parts(x: Column) -> Column:
    """Numbers of v1.2.3 for comparison; null if x is no version."""
    bare = F.regexp_replace(x, "^[vV]", "")
    return F.when(bare.rlike(r"^\d+(\.\d+)*$"), F.transform(F.split(bare, "[.]"), lambda p: p.cast("int")))


def attributes(x: Column) -> Column:
    """k=v;k=v as a map."""
    return F.str_to_map(F.regexp_replace(x, ";+$", ""), F.lit(";"), F.lit("="))


def remap_field(x: Column, sep: str, old: list[str], new: str) -> Column:
    """Fields of a separated text that are among the old names, renamed."""
    parts = F.split(x, f"[{sep}]")
    return F.array_join(F.transform(parts, lambda p: F.when(p.isin(*old), F.lit(new)).otherwise(p)), sep)


def run_id(stamp: Column) -> Column:
    """A time in ISO form without colons."""
    return F.translate(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"), ":", "")


def whole_genome_size(residues: Column) -> Column:
    """Base pairs of a genome of which only proteins are known."""
    return F.floor(residues * 3 * F.lit(1.1)).cast("long")


def wrapped(x: Column, width: int = 80) -> Column:
    """Lines of at most width characters."""
    return F.regexp_replace(F.regexp_replace(x, f"(.{{{width}}})", "$1\n"), "\n$", "")


def version_label(x: Column) -> Column:
    """A version with a v before its number; 'unknown' for nothing; other texts as they are, but for 'unknown' and 'not installed' in lower case."""
    text = F.trim(F.coalesce(x, F.lit("")))
    return (
        F.when(text == "", "unknown").when(F.lower(text).isin("unknown", "not installed"), F.lower(text)).when(text.rlike("^[0-9]"), F.concat(F.lit("v"), text)).otherwise(text)
    )


def prefix_slug(prefixes: Column) -> Column:
    """A file name's part for an array of prefixes: lower case, other characters as underscores, joined; 'refs' for nothing."""
    clean = lambda p: F.regexp_replace(F.regexp_replace(F.lower(F.replace(p, F.lit("-"), F.lit("_"))), "[^a-z0-9_]+", "_"), "^_+|_+$", "")
    joined = F.array_join(F.filter(F.transform(prefixes, clean), lambda p: p != ""), "_")
    return F.when(joined == "", "refs").otherwise(joined)


#: Between sequences of one training text, and behind the last of several: stops in all frames.
SPACER = "TTAATTAATTAA"


def training_text(sequences: Column) -> Column:
    """An array of sequences as one text, in order, in which no gene can span two."""
    return F.concat(F.array_join(sequences, SPACER), F.when(F.size(sequences) > 1, SPACER).otherwise(""))


def first_given(*settings: Column) -> Column:
    """The first setting that is neither null nor blank: flag, environment, file, default."""
    return F.coalesce(*(F.when(F.trim(s) != "", s) for s in settings))
