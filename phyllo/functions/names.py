"""Scientific names as Catalyst expressions: canonical form, slug, id, genus, epithet, variants.

All of it runs in the JVM: accents fold by a translation table that is built from the Unicode rule (letters of the Latin
blocks and what their decomposition leaves), and the canonical form is one anchored pattern over the folded name.
Defined results: null and blank names give ''; a name of a hybrid sign only gives ''.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rank abbreviations of infraspecific names. Fixed values.
RANKS = ("subsp", "ssp", "var", "f", "forma", "cv", "subvar")
CROSS = "×"
#: Apostrophes around cultivar names, besides the straight one. Fixed values.
APOSTROPHES = "‘’ʻʼʽ′`´"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def _latin() -> tuple[str, str]:
    """Accented letters of the Latin blocks and their base letters."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents(c: Column | str) -> Column:
    """Letters without their accents, composed or decomposed; case and everything else stay."""
    a, b = _latin()
    return F.translate(F.regexp_replace(_c(c), r"\p{Mn}+", ""), a, b)


def canonical_name(c: Column | str) -> Column:
    """Genus, hybrid sign, epithet, ranks and quoted cultivars; authors, years and what follows them fall away."""
    s = F.regexp_replace(fold_accents(F.coalesce(_c(c), F.lit(""))), "_", " ")
    s = F.regexp_replace(s, rf"{CROSS}(?=\S)", f"{CROSS} ")
    s = F.trim(F.regexp_replace(s, r"(?U)\s+", " "))
    s = F.trim(F.regexp_replace(F.regexp_replace(s, "(?<= |^)[,;]+|[,;]+(?= |$)", ""), " +", " "))
    cross, quote = f"[xX{CROSS}]", "'\"‘“"
    epithet = rf"(?![{quote}(])(?:(?!\p{{Lu}})[^ \d]+|\p{{Lu}}{{3,}}) "
    rank = rf"(?i:{'|'.join(RANKS)})\.* "
    tail = rf"(?:{cross} )*(?:(?!{rank}){epithet})?(?:{rank}(?:{cross} )*(?:(?!{rank}){epithet})?|[{quote}][^ ]* )*"
    # the sign of an intergeneric hybrid comes before the genus, however often it is written
    kept = F.regexp_extract(F.concat(s, F.lit(" ")), rf"^(?:{cross} )?[^ ]+ {tail}", 0)
    head = F.regexp_extract(kept, rf"^{cross} ", 0) != ""
    words = F.split(F.trim(kept), " ")

    def word(w: Column, i: Column) -> Column:
        is_genus = i == F.when(head, 1).otherwise(0)
        low = F.regexp_replace(F.lower(w), r"\.+$", "")
        return (
            F.when(is_genus, F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 10_000))))
            .when(w.rlike(f"^{cross}$"), F.lit(CROSS))
            .when(w.rlike(f"^[{quote}]"), F.concat(F.lit("'"), F.regexp_replace(w, "^['\"‘’“”]+|['\"‘’“”]+$", ""), F.lit("'")))
            .when(low.isin(*RANKS), F.concat(low, F.lit(".")))
            .otherwise(low)
        )

    name = F.array_join(F.transform(words, word), " ")
    return F.when(s == "", F.lit("")).otherwise(F.trim(F.regexp_replace(name, f"(^| ){CROSS}$", "")))


def slug(canonical: Column | str) -> Column:
    """A folder name: ASCII letters and digits, runs of anything else as one underscore."""
    s = F.regexp_replace(fold_accents(canonical), CROSS, "x")
    return F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def internal_id(name: Column | str) -> Column:
    return F.regexp_replace(F.lower(slug(canonical_name(name))), "_", "-")


def genus_of(canonical: Column | str) -> Column:
    """The first word that is no hybrid sign before the genus."""
    words = F.split(_c(canonical), " ")
    at = F.when((words[0] == CROSS) & (F.size(words) > 1), 2).otherwise(1)
    return F.coalesce(F.try_element_at(words, at), F.lit(""))


def epithet_of(canonical: Column | str) -> Column:
    words = F.split(_c(canonical), " ")
    at = F.when((F.try_element_at(words, F.lit(2)) == CROSS) & (F.size(words) > 2), 3).otherwise(2)
    return F.coalesce(F.try_element_at(words, at), F.lit(""))


def comparable(name: Column | str) -> Column:
    """Lower case without hybrid signs, for comparing names across services."""
    s = F.regexp_replace(F.lower(_c(name)), rf"\s*(?:{CROSS}|\bx\b)\s*", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def without_cross(id_: Column | str) -> Column:
    """An id without its x parts: the one key that all variants of a plant's id share."""
    return F.array_join(F.filter(F.split(_c(id_), "-"), lambda p: p != "x"), "-")


def id_variants(id_: Column | str) -> Column:
    """The id, the id without x parts, and with one x after the genus."""
    parts = F.filter(F.split(_c(id_), "-"), lambda p: p != "x")
    crossed = F.when(F.size(parts) > 1, F.concat(parts[0], F.lit("-x-"), F.array_join(F.slice(parts, 2, 1000), "-")))
    return F.array_distinct(F.array_compact(F.array(_c(id_), without_cross(id_), crossed)))


def title_variants(name: Column | str) -> Column:
    """The name as it is, with x and without a hybrid sign, distinct without regard to case."""
    own = F.trim(_c(name))
    x = F.trim(F.regexp_replace(F.regexp_replace(own, CROSS, "x"), r"\s+", " "))
    bare = F.trim(F.regexp_replace(F.regexp_replace(own, rf"{CROSS}|\bx\b", " "), r"\s+", " "))
    keep = lambda v, *before: F.when(~F.lower(v).isin(*[F.lower(b) for b in before]), v) if before else v
    return F.filter(F.array_compact(F.array(own, keep(x, own), keep(bare, own, x))), lambda v: v != "")


def cultivar(name: Column | str, parent: Column | str) -> Column:
    """The cultivar of a trade name: what is quoted, else a capitalised rest after the parent name that is no rank; else null."""
    s = F.trim(F.translate(_c(name), APOSTROPHES, "'" * len(APOSTROPHES)))
    quoted = F.trim(F.regexp_extract(s, "'([^']+)'", 1))
    own = F.trim(_c(parent))
    rest = F.when(F.startswith(F.lower(s), F.lower(own)) & (own != ""), F.trim(F.substr(s, F.length(own) + 1)))
    plain = F.when(rest.rlike(r"^\p{Lu}") & ~F.regexp_replace(F.lower(F.substring_index(rest, " ", 1)), r"\.$", "").isin(*RANKS), rest)
    return F.when(quoted != "", quoted).otherwise(plain)
