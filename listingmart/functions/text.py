"""String functions: Column -> Column, all built from JVM-side expressions.

None of these registers a Python UDF; each stays inside whole-stage codegen
(or the interpreted higher-order-function path for the array lambdas).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listingmart.functions.util import as_col

# Fixed values (must equal the reference's): lower-case particles of the
# French title case, kept lower-case unless they are the first word.
FRENCH_PARTICLES = ["et", "de", "du", "des", "la", "le", "les", "d'", "l'"]

# The separator patterns used by the reference.
SLASH_PATTERN = r"\s*/\s*"
NAME_SPLIT_PATTERN = r"\s*,\s*|\s*-\s*|\s+&\s*|\s*&\s+"
LOCATION_SPLIT_PATTERN = r"\s*,\s*"

# Letter runs and non-letter runs; a letter run is title-cased on its own,
# which is what "upper-case each letter that follows a non-letter" means.
_RUNS = r"(\p{L}+|[^\p{L}]+)"
_WS = r"(?U)\s+"
# A word whose only letters form its first run (sharp s excluded: its title form is "Ss").
_SIMPLE_WORD = r"^[\p{L}&&[^ß]]\p{L}*[^\p{L}]*$"


def _title_first(ch: Column) -> Column:
    # Title case of one character: as upper case, except the sharp s whose
    # title form is "Ss" (Java's upper case gives "SS").
    return F.when(ch == "ß", F.lit("Ss")).otherwise(F.upper(ch))


def _title_run(run: Column) -> Column:
    return F.when(
        run.rlike(r"^\p{L}"),
        F.concat(_title_first(F.substring(run, 1, 1)), F.lower(F.substring(run, 2, 1 << 30))),
    ).otherwise(run)


def title_case(c) -> Column:
    """upper-case every letter that follows a non-letter, lower-case the rest.

    ``initcap`` is not the same (it only splits on spaces), so the text is cut
    into letter / non-letter runs and each letter run is capitalised.
    """
    c = as_col(c)
    runs = F.regexp_extract_all(c, F.lit(_RUNS), 1)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform(runs, _title_run), "")
    )


def capitalize(c) -> Column:
    """first character in title case, the rest lower case."""
    c = as_col(c)
    return F.concat(_title_first(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def french_titlecase(c) -> Column:
    """French title case of a label.

    Per whitespace-separated word: a word starting with ``d'``/``l'`` keeps its
    two-letter prefix and capitalises the rest; a particle is lower-cased
    unless it is the first word; an all-caps word is kept; anything else is
    title-cased. Whitespace runs collapse to one space. NULL and '' pass through.
    """
    c = as_col(c)
    trimmed = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    words = F.split(trimmed, _WS)
    particles = F.array(*[F.lit(p) for p in FRENCH_PARTICLES])

    def word(w: Column, i: Column) -> Column:
        lw = F.lower(w)
        return (
            F.when(lw.startswith("d'") | lw.startswith("l'"),
                   F.concat(F.substring(w, 1, 2), capitalize(F.substring(w, 3, 1 << 30))))
            .when((i != 0) & F.array_contains(particles, lw), lw)
            .when(w == F.upper(w), w)
            # a letter run and trailing non-letters: title case is initcap (JVM, no lambda)
            .when(w.rlike(_SIMPLE_WORD), F.initcap(w))
            .otherwise(title_case(w))
        )

    out = F.array_join(F.transform(words, word), " ")
    return F.when(c.isNull() | (c == ""), c).otherwise(out)


def slash_to_comma(c) -> Column:
    """``a / b`` -> ``a, b``."""
    return F.regexp_replace(as_col(c), SLASH_PATTERN, ", ")


def split_names(c) -> Column:
    """split a label into names on ``,`` ``-`` or a spaced ``&`` (``R&D`` stays whole)."""
    return F.split(as_col(c), NAME_SPLIT_PATTERN)


def first_word_lower(c) -> Column:
    """the text before the first single space, lower-cased."""
    return F.lower(F.element_at(F.split(as_col(c), " "), 1))


def md5_hex8(c, n: int = 8) -> Column:
    """F8: first ``n`` hex digits of md5 over the UTF-8 bytes."""
    return F.substring(F.md5(as_col(c).cast("binary")), 1, n)


def concat_as_string(*cols, null_text: str = "None") -> Column:
    """every column rendered as text (NULL -> ``None``), joined without separator."""
    return F.concat(*[F.coalesce(as_col(c).cast("string"), F.lit(null_text)) for c in cols])


_UNESCAPE = "org.apache.commons.text.StringEscapeUtils"


def unicode_repair(c) -> Column:
    """repair escaped code points that lost their backslash.

    Without a backslash in the text, ``u`` + a decimal digit + three hex digits
    becomes that code point (``Bu00e9jau00efa`` -> ``Béjaïa``); any other text,
    e.g. ``Menu2`` or ``succeder``, is kept. With a backslash, only ``\\uXXXX``
    escapes are decoded (a surrogate pair as one character); every other
    backslash is kept as it is.

    The text gets backslashes where codes are to be decoded (and doubled ones
    elsewhere) by ``regexp_replace``, then one JVM call per text
    (``java_method`` on the unescape routine shipped with Spark) decodes it:
    no Python, one pass over each whole text.
    """
    c = as_col(c)
    bare = F.regexp_replace(c, r"u([0-9][0-9a-fA-F]{3})", r"\\u$1")
    escaped = F.regexp_replace(c, r"\\(?!u[0-9a-fA-F]{4})", r"\\\\")
    prepared = F.when(F.instr(c, "\\") == 0, bare).otherwise(escaped)
    decoded = F.call_function("java_method", F.lit(_UNESCAPE), F.lit("unescapeJava"), prepared)
    return F.when(c.isNotNull(), decoded)


def split_location(c) -> Column:
    """split a location text on commas with surrounding blanks."""
    return F.split(as_col(c), LOCATION_SPLIT_PATTERN)


def position(sub: str, c) -> Column:
    """1-based position of ``sub`` in the text, 0 if absent."""
    return F.instr(as_col(c), sub)
