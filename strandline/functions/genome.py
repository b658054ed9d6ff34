"""Column expressions for reads, intervals and chromosomes. Coordinates are 1-based and closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bits of the SAM flag.
FLAGS = {"paired": 1, "proper": 2, "unmapped": 4, "mate_unmapped": 8, "reverse": 16, "mate_reverse": 32, "secondary": 256, "qc_fail": 512, "duplicate": 1024, "supplementary": 2048}


def mask(*names: str) -> int:
    return sum(FLAGS[n] for n in names)


def has_flag(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(FLAGS[name]) != 0


def passes(flag: Column, required: int, excluded: int) -> Column:
    """All bits of required set, none of excluded."""
    return (flag.bitwiseAND(required) == required) & (flag.bitwiseAND(excluded) == 0)


def strand(flag: Column) -> Column:
    return F.when(has_flag(flag, "reverse"), "-").otherwise("+")


def pair_orientation(flag: Column) -> Column:
    side = lambda name: F.when(has_flag(flag, name), "R").otherwise("F")
    return F.concat(side("reverse"), side("mate_reverse"))


def cigar_ref_length(cigar: Column) -> Column:
    """Reference bases of a CIGAR string: the lengths of M, D, N, = and X; 0 for ``*`` and empty."""
    parts = F.regexp_extract_all(cigar, F.lit(r"([0-9]+)[MDN=X]"), F.lit(1))
    return F.coalesce(F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")), F.lit(0).cast("long"))


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def int_median(c: Column) -> Column:
    """Median rounded half up."""
    return F.floor(F.median(c) + 0.5).cast("long")


def chrom_norm(c: Column, mt_alias: bool = True) -> Column:
    """``chrN`` and ``N`` are one; with mt_alias so are M and MT."""
    bare = F.regexp_replace(c, "(?i)^chr", "")
    return F.when(F.upper(bare).isin("M", "MT"), "M").otherwise(bare) if mt_alias else bare


def chrom_rank(c: Column) -> Column:
    """1-22 by number, X 23, Y 24, M 25, others after them; ties are to be broken by name."""
    bare = F.upper(F.regexp_replace(c, "(?i)^chr", ""))
    return F.when(bare.rlike("^[0-9]{1,6}$"), bare.cast("int")).when(bare == "X", 23).when(bare == "Y", 24).when(bare.isin("M", "MT"), 25).otherwise(1000)


def is_canonical(c: Column) -> Column:
    return c.rlike("^(chr)?([1-9]|1[0-9]|2[0-2]|X|Y)$")


def strip_version(c: Column) -> Column:
    """Transcript name without its version: ``.1_2`` first, then ``.1``."""
    return F.regexp_replace(F.regexp_replace(c, r"\.\d+_\d+$", ""), r"\.\d+$", "")


def na_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.isin("", "NA"), None).otherwise(t)


def gtf_attribute(attributes: Column, key: str) -> Column:
    """Value of ``key "value"``, ``key value`` or ``key=value``; null if absent."""
    form = rf'(?:^|;)\s*{key}(?:\s+"([^"]*)"|\s*[= ]\s*([^;"]*))'
    found, other = (F.regexp_extract(attributes, form, i) for i in (1, 2))
    return F.when(found != "", found).when(other != "", F.trim(other))


def region_text(chrom: Column, start: Column, end: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def range_text(low: Column, high: Column) -> Column:
    return F.concat(low.cast("string"), F.lit("-"), high.cast("string"))


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))


def fixed(c: Column, digits: int) -> Column:
    """Text with so many decimals, halves to even as in C (judged on the shortest decimal form of the double); null stays null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", F.bround(c, digits)))


def fixed_exact(c: Column, digits: int) -> Column:
    """Text of a number from 0 up with so many decimals, rounded by the double's exact binary value as in C (halves of that value to even).

    The product with a power of ten is taken in two exact parts, so the side of a half on which it lies is not lost in rounding.
    """
    power = 10**digits
    wide = c * 134217729.0  # 2 ** 27 + 1 splits a double in two halves
    high = wide - (wide - c)
    down = F.floor(c * power)
    side = (high * (2.0 * power) - (2 * down + 1)) + (c - high) * (2.0 * power)
    whole = F.when((side > 0) | ((side == 0) & (down % 2 == 1)), down + 1).otherwise(down)
    return F.concat(F.floor(whole / power).cast("string"), F.lit("."), F.lpad((whole % power).cast("string"), digits, "0"))


def file_safe(c: Column) -> Column:
    """Runs of anything but word characters, dots and hyphens are one underscore."""
    return F.regexp_replace(c, r"[^\w.\-]+", "_")


def exon_names(exon_id: Column, number: Column) -> tuple[Column, Column]:
    """(id, number) of an exon, each from the other where it is missing: EX12 and 12."""
    i, n = na_to_null(exon_id), na_to_null(number)
    digits = F.regexp_extract(i, r"(?i)EX(\d+)", 1)
    return F.coalesce(i, F.concat(F.lit("EX"), n)), F.coalesce(n, F.when(digits != "", digits))


def gene_of_file(path: Column) -> Column:
    """Gene named in the file name of a depth table: ``_GENE_NM_1`` or ``HCM_GENE_DEL``; else null."""
    base = F.regexp_replace(F.regexp_replace(na_to_null(path), r"^.*/", ""), r"\.depth\.tsv$", "")
    by = [F.regexp_extract(base, x, 1) for x in (r"_([A-Za-z0-9.-]+)_N[MR]_\d+", r"^HCM_([A-Za-z0-9.-]+)_DEL")]
    return F.when(by[0] != "", by[0]).when(by[1] != "", by[1])


def yes_no(value: Column) -> Column:
    """Support values as Yes or No; other texts stay, NA and empty are null."""
    v = na_to_null(value)
    yes, no = v.rlike("(?i)^(1|yes|true|pass|support|supported)$"), v.rlike("(?i)^(0|no|false|fail|none|unsupported)$")
    return F.when(yes | (v.try_cast("double") > 0), "Yes").when(no, "No").otherwise(v)
