"""Column expressions for cleaning and tokenizing text (all JVM built-ins).

Two tokenizing profiles share one gram model:

* ``CHAR`` - the retrieval model's own: a field is cleaned (control
  characters and a set of punctuation marks deleted), split into
  characters, every non-blank character is a unigram and every pair of
  adjacent non-blank characters is a bigram; a blank breaks the chain.
* ``WORD`` - for space-separated scripts: lower-cased runs of letters and
  digits are the terms, adjacent terms form bigrams.

Every function returns a ``Column`` so that Catalyst keeps the work inside
whole-stage code generation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the retrieval model (they must stay exactly as they are).
# Control characters deleted from every field before tokenizing.
CONTROL_CHARS = "\n\r\t"
# Full-width punctuation marks deleted from every field: comma, enumeration
# comma, full stop, exclamation mark, colon, question mark.
FULLWIDTH_MARKS = "，、。！：？"
# Separator between the entries of a topic's concepts field.
CONCEPT_DELIMITER = "、"
# A topic number is the last three characters of the trimmed number field.
TOPIC_NUMBER_WIDTH = 3
# ---------------------------------------------------------------------------

# Characters that a trimmed vocabulary line can never hold (Unicode white
# space as Python's str.isspace sees it). Written with \x{..} escapes so the
# same class works in Java regex and RE2.
BLANK_CLASS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}"
               r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same characters one by one.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# A word is a run of letters and digits.
WORD_PATTERN = r"[\p{L}\p{N}]+"

# Unigram rows carry this in the second term column, never NULL (NULL keys do
# not equi-join).
NO_TERM = ""


def strip_control(col: Column | str) -> Column:
    """Delete newline, carriage return and tab; spaces stay."""
    return F.translate(_c(col), CONTROL_CHARS, "")


def strip_punct(col: Column | str, marks: str = FULLWIDTH_MARKS) -> Column:
    """Delete each of ``marks``; every other character stays."""
    return F.translate(_c(col), marks, "")


def clean_field(col: Column | str, marks: str = FULLWIDTH_MARKS) -> Column:
    """Punctuation marks, then control characters, deleted."""
    return strip_control(strip_punct(col, marks))


def char_split(col: Column | str) -> Column:
    """String to its characters (code points); the empty string gives []."""
    return F.array_remove(F.split(_c(col), ""), "")


def char_unigrams(col: Column | str) -> Column:
    """Every character of the string, blanks included."""
    return char_split(col)


def char_bigrams(col: Column | str) -> Column:
    """Every pair of adjacent characters as ``struct<t1, t2>``."""
    return adjacent_pairs(char_split(col))


PAIRS_TYPE = "array<struct<t1:string,t2:string>>"
GRAMS_TYPE = "array<struct<n:int,t1:string,t2:string>>"


def _tail(seq: Column) -> tuple[Column, Column]:
    """``seq[1..n-1]`` and ``seq[2..n]`` (both empty when n < 2)."""
    m = F.greatest(F.size(seq) - 1, F.lit(0))
    return (F.when(m > 0, F.slice(seq, 1, m)).otherwise(F.array().cast("array<string>")),
            F.when(m > 0, F.slice(seq, 2, m)).otherwise(F.array().cast("array<string>")))


def adjacent_pairs(seq: Column) -> Column:
    """``array<struct<t1, t2>>`` of neighbours; arrays under two give [].

    Built from ``slice`` + ``arrays_zip`` (no lambda functions), which keeps
    it inside generated code."""
    a, b = _tail(seq)
    return F.arrays_zip(a, b).cast(PAIRS_TYPE)


def word_tokens(col: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in text order."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD_PATTERN), 0)


def is_blank(x: Column) -> Column:
    return x.rlike("^" + BLANK_CLASS + "$")


@dataclass(frozen=True)
class Profile:
    """How a text field becomes an ordered sequence of items.

    ``sequence`` gives the items in text order; blank items (CHAR profile
    only) are kept in the sequence so that they break bigrams, but never
    become terms themselves.
    """

    name: str
    marks: str = FULLWIDTH_MARKS

    def sequence(self, text: Column | str) -> Column:
        if self.name == "word":
            return word_tokens(text)
        # Every blank is a space first, so the per-character test below is a
        # plain comparison.
        return char_split(self.folded(text))

    def gram_runs(self, text: Column | str) -> Column:
        """CHAR texts: every character with the one after it, sorted and joined to
        one string. A blank ends the text. See :meth:`run_strings`."""
        pairs = F.regexp_extract_all(F.concat(self.folded(text), F.lit(" ")), F.lit(r"(?s)(?=([^ ].))[^ ]"), F.lit(1))
        return F.array_join(F.sort_array(pairs), "")

    def run_strings(self, ordered: Column, orders: tuple[int, ...] = (1, 2)) -> Column:
        """One string per distinct gram of :meth:`gram_runs`: the gram as often as
        it occurs, a unigram with a blank behind it. Equal grams stand side by
        side, so a group and its repeats match a whole run: grams are counted
        inside the row and a document's occurrences never become rows."""
        runs = {1: (F.regexp_replace(ordered, r"(?s)(.).", "$1 "), r"(?s)(. )\1*"), 2: (ordered, r"([^ ][^ ])\1*")}
        parts = [F.regexp_extract_all(runs[n][0], F.lit(runs[n][1]), F.lit(0)) for n in orders]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def run_gram(self, run: Column) -> list[Column]:
        """``n, t1, t2, tf`` of one of the :meth:`run_strings`."""
        two = ~run.endswith(" ")
        t1, last = F.left(run, F.lit(1)), F.substring(run, 2, 1)
        unit = F.octet_length(t1) + F.octet_length(last)
        return [F.when(two, 2).otherwise(1).alias("n"), t1.alias("t1"), F.when(two, last).otherwise(NO_TERM).alias("t2"),
                (F.octet_length(run) / unit).cast("long").alias("tf")]

    def folded(self, text: Column | str) -> Column:
        """CHAR text with marks and control characters deleted and every blank a
        space, in one pass."""
        blanks = "".join(c for c in BLANKS if c not in CONTROL_CHARS and c not in self.marks)
        return F.translate(_c(text), blanks + self.marks + CONTROL_CHARS, " " * len(blanks))

    def has_blanks(self) -> bool:
        return self.name != "word"

    def terms(self, seq: Column) -> Column:
        """The unigram terms of a sequence (blanks dropped)."""
        if not self.has_blanks():
            return seq
        return F.array_remove(seq, " ")

    def length(self, seq: Column) -> Column:
        """Number of unigram terms: the document length of the model."""
        return F.size(self.terms(seq)).cast("long")

    def grams(self, seq: Column, orders: tuple[int, ...] = (1, 2)) -> Column:
        """``array<struct<n:int, t1:string, t2:string>>`` of all grams.

        Built with ``arrays_zip``/``array_repeat``/``slice`` only; for the
        CHAR profile the blank-containing grams are still in the array and
        must be dropped with :meth:`gram_filter` after exploding (a row
        filter in generated code is far cheaper than lambda functions)."""
        parts = []
        if 1 in orders:
            size = F.size(seq)
            parts.append(F.arrays_zip(F.array_repeat(F.lit(1), size), seq,
                                      F.array_repeat(F.lit(NO_TERM), size)).cast(GRAMS_TYPE))
        if 2 in orders:
            a, b = _tail(seq)
            m = F.size(a)
            parts.append(F.arrays_zip(F.array_repeat(F.lit(2), m), a, b).cast(GRAMS_TYPE))
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def gram_filter(self, t1: Column, t2: Column) -> Column | None:
        """Row predicate that drops grams holding a blank (None: keep all)."""
        if not self.has_blanks():
            return None
        return (t1 != " ") & (t2 != " ")


WORD = Profile("word")
CHAR = Profile("char")


def profile_named(name: str | Profile) -> Profile:
    if isinstance(name, Profile):
        return name
    return {"word": WORD, "char": CHAR}[name]


def trim_blanks(col: Column | str) -> Column:
    """Strip leading and trailing white space (all of BLANK_CLASS)."""
    return F.regexp_replace(_c(col), "^" + BLANK_CLASS + "+|" + BLANK_CLASS + "+$", "")


def topic_number(col: Column | str) -> Column:
    """Last three characters of the trimmed number field."""
    return F.right(trim_blanks(col), F.lit(TOPIC_NUMBER_WIDTH))


def doc_key(col: Column | str) -> Column:
    """Last part of a slash-separated path, lower-cased."""
    return F.lower(F.substring_index(_c(col), "/", -1))


def doc_path(collection_dir: str, listed: Column | str) -> Column:
    """Join the collection folder and a listed path.

    When the listed path starts with the folder's own last name, that part
    is not repeated (``/data/coll`` + ``coll/a/b`` gives ``/data/coll/a/b``).
    """
    base = collection_dir.rstrip("/")
    last = base.rsplit("/", 1)[-1]
    listed = _c(listed)
    head = F.substring_index(listed, "/", 1)
    parent = base[: len(base) - len(last)].rstrip("/")
    prefix_parent = F.lit(parent + "/" if parent else "")
    return F.when(head == F.lit(last), F.concat(prefix_parent, listed)) \
            .otherwise(F.concat(F.lit(base + "/"), listed))


# --- document XML / HTML text -------------------------------------------

# XML's five predefined entities, decoded as an XML parser would (&amp; last).
XML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def decode_xml_entities(col: Column | str) -> Column:
    out = _c(col)
    for entity, char in XML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def strip_tags(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), r"<[^>]*>", "")


def html_title(html: Column | str) -> Column:
    """Text of the first ``<title>`` element, NULL when there is none."""
    t = F.regexp_extract(_c(html), r"(?is)<title\b[^>]*>(.*?)</title>", 1)
    has = _c(html).rlike(r"(?is)<title\b[^>]*>.*?</title>")
    return F.when(has, decode_xml_entities(strip_tags(t)))


def html_paragraphs(html: Column | str) -> Column:
    """Texts of the closed ``<p>...</p>`` elements outside scripts and styles.

    A paragraph is the text between a ``<p>`` tag and the next ``</p>`` with
    no other ``<p>`` tag between them; inner tags are dropped, entities decoded.
    """
    body = F.regexp_replace(_c(html), r"(?is)<script\b[^>]*>.*?</script>", "")
    body = F.regexp_replace(body, r"(?is)<style\b[^>]*>.*?</style>", "")
    pieces = F.split(body, r"(?i)<p\b")
    after_first = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    closed = F.filter(after_first, lambda s: F.locate("</p>", F.lower(s)) > 0)
    return F.transform(closed, lambda s: decode_xml_entities(strip_tags(
        F.regexp_extract(s, r"(?is)^[^>]*>(.*?)</p>", 1))))


def cleaned_length(col: Column, marks: str = FULLWIDTH_MARKS) -> Column:
    return F.length(clean_field(col, marks)).cast("long")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
