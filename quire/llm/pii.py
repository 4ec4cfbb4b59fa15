"""Personal data replaced by keyed surrogates. Built-in functions only.

Entities (e-mail and IP addresses, phone, card, account and social-security
numbers, access keys, secret values, names after a title) are found by one
pattern. Each is made of parts, and each distinct part gets one surrogate for
the whole corpus: characters drawn from a keyed SHA-512 of its type and
normalised value, in the part's own format. Letters stay letters of the same
case and script, digits stay digits, separators stay; octets stay octets,
card numbers keep their first digit and a valid check digit, phone numbers
their country code, access keys their prefix, top-level domains stay, and
names keep gender (by title) and script. Differently formatted mentions of one
value share its surrogate, and so do a full name and a surname alone.

Coreference: the words of a name that a document gives after a title are looked
for in the whole document, and every later or earlier mention of them alone gets
the same surrogate.

Collision check: surrogates of a type are distinct and never equal a value
that occurs. What collides draws again, with more freedom after some draws.

Defined results: a null text stays null; texts without an entity come out
unchanged; a null or repeated ``doc_id`` keeps its row; texts of any length are
searched whole; equal values at any places have one surrogate; columns other
than ``text`` pass through, but for ``n_entities``, which is set anew; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.scratch import Scratch

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин", "κ", "κος", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа", "κα", "κυρία")
NEUTRAL = ("Dr", "Prof")
TITLE = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
EMAIL = r"[\p{L}0-9._%+\-]+@[\p{L}0-9\-]+(?:\.[\p{L}0-9\-]+)*\.\p{L}{2,}"
IP = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?![\d]|\.\d)"
IP6 = r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])"
ACCESS_KEY = r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"
LABEL = "(?i:password|passwd|pwd|token|secret|api_key|apikey|api-key)"
SECRET = rf"(?<={LABEL}[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?)[A-Za-z0-9+/_\-]{{8,}}|(?<=(?i:tel|tél|phone|fon)[.:]{{0,2}} )0\d{{2,4}}[ /\-]?\d{{5,8}}(?!\d)"
ACCOUNT = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
SOCIAL = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
CARD = r"(?<![\d.\-])\d(?:[ \-]?\d){12,18}(?![\d\-])"
PHONE = (r"(?<![\w+])\+\d{1,3}(?:[ .\-]?\(\d{1,4}\))?(?:[ .\-]?\d{2,4}){2,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)"
         r"|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])")
NAME = rf"(?<!\p{{L}})(?:{TITLE})\.? \p{{Lu}}\p{{Ll}}+(?:[ \-]\p{{Lu}}\p{{Ll}}+)?"
KINDS = (("email", EMAIL), ("ip", IP), ("ip6", IP6), ("access", ACCESS_KEY), ("secret", SECRET), ("social", SOCIAL), ("phone", PHONE),
         ("card", CARD), ("account", ACCOUNT), ("name", NAME))
ENTITY = "|".join(f"(?:{p})" for _, p in KINDS)
HINT = rf"[0-9@]|(?<!\p{{L}})(?:{TITLE})(?!\p{{L}})|{LABEL}|:[a-fA-F]"     # every entity has one of these
FREE_AFTER = 8      # draws in the exact format before longer surrogates are allowed
# Syllables of invented names by script, and endings by gender.
SYLLABLES = {
    "latin": ("ba be bo da del do fa fe ga go ha hel jo ka kel la le lo ma mel mo na nel no pa pe ra rel ro sa sel so ta tel to va vel vo za".split()),
    "cyrillic": ("ба ве га да ел жа за ка ки ла ле ма ме на не па ра ре са се та ти фа хо".split()),
    "greek": ("βα γα δα ελ ζα θα κα λα λε μα με να νι πα ρα ρο σα τα φα χα".split()),
}
ENDINGS = {
    "latin": {"m": ["n", "r", "s", "k"], "f": ["a", "ia", "ine", "ana"], "s": ["mann", "son", "ez", "ier"]},
    "cyrillic": {"m": ["н", "р", "м", "к"], "f": ["а", "ия", "ина", "ья"], "s": ["ов", "ин", "ко", "ич"]},
    "greek": {"m": ["ος", "ης", "ας", "ων"], "f": ["α", "η", "ια", "ινα"], "s": ["ης", "ου", "ας", "ιδης"]},
}
SCRIPT_OF = {"cyrillic": r"^\p{IsCyrillic}", "greek": r"^\p{IsGreek}"}


def found(docs: DataFrame, pattern: Column | str = f"({ENTITY})") -> DataFrame:
    """Adds ``_entities`` and the ``_pieces`` of text around them."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return docs.withColumn("_entities", F.regexp_extract_all("text", pattern, F.lit(1))).withColumn("_pieces", F.split("text", pattern, -1))


def _kind(value: Column) -> Column:
    """The kind of a found entity. A secret is what no other pattern spells."""
    out = F.lit("secret")
    for kind, pattern in reversed([k for k in KINDS if k[0] != "secret"]):
        out = F.when(value.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _parts(kind: Column, value: Column) -> Column:
    """Parts of an entity: ``type``, ``said`` (as it stands in the text; null
    for text that stays) and ``norm`` (what identifies it)."""
    part = lambda t, said, norm: F.struct(F.lit(t).alias("type") if isinstance(t, str) else t.alias("type"),
                                          said.alias("said"), norm.alias("norm"))
    digits = F.regexp_replace(value, r"\D", "")
    stays = lambda text: part("", text, F.lit(None).cast("string"))
    local, domain = F.regexp_extract(value, r"^(.*)@", 1), F.regexp_extract(value, r"@(.*)\.", 1)
    title = F.regexp_extract(value, rf"^((?:{TITLE})\.? )", 1)
    one, sep, two = (F.regexp_extract(value, rf"^(?:{TITLE})\.? (\p{{L}}+)([ \-]?)(\p{{L}}*)$", i) for i in (1, 2, 3))
    bare = F.regexp_replace(title, r"\.? $", "")
    gender = F.when(bare.isin(*FEMALE), "given_f").when(bare.isin(*MALE), "given_m").otherwise("given_n")
    prefix = F.regexp_extract(value, r"^(\+\d{1,3}(?=\D))", 1)
    return (F.when(kind == "email", F.array(part("email", local, F.lower(value)), stays(F.lit("@")), part("domain", domain, F.lower(domain)),
                                            stays(F.regexp_extract(value, r"(\.[^.]*)$", 1))))
             .when((kind == "name") & (two != ""), F.array(stays(title), part(gender, one, F.concat(gender, F.lit(":"), F.lower(one))), stays(sep), part("surname", two, F.lower(two))))
             .when(kind == "name", F.array(stays(title), part("surname", one, F.lower(one))))
             .when(kind == "phone", F.array(stays(prefix), part("phone", F.expr("substring(value, length(regexp_extract(value, '^(\\\\+\\\\d{1,3}(?=\\\\D))', 1)) + 1)"), digits)))
             .when(kind == "access", F.array(stays(F.substring(value, 1, 4)), part("access", F.expr("substring(value, 5)"), value)))
             .when(kind.isin("card", "social"), F.array(part(kind, value, digits)))
             .when(kind == "account", F.array(stays(F.substring(value, 1, 2)), part("account", F.expr("substring(value, 3)"), F.regexp_replace(value, " ", ""))))
             .otherwise(F.array(part(kind, value, value))))


def _stream(key: str, draw: int) -> Column:
    """256 keyed hex bytes for a part's type and value at a draw."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), "type", "norm", F.lit(f"{draw}.{i}")), 512) for i in range(4)])


def _byte(i: Column) -> Column:
    return F.conv(F.substring(F.col("stream"), (i % 256) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _spelled(said: Column, loose: bool) -> Column:
    """Characters of the surrogate for a plain part: same classes as ``said``."""
    hexed = F.lower(said).rlike("^[0-9a-f:]+$")
    out = F.transform(F.split(said, ""), lambda c, i:
                      F.when(c.rlike(r"^\d$"), F.when((i == 0) & (F.col("type") == "phone"), 2 + _byte(i) % 8).otherwise(_byte(i) % 10).cast("string"))
                       .when(hexed & c.rlike("^[a-fA-F]$"), F.chr((97 + _byte(i) % 6).cast("int")))
                       .when(c.rlike(r"^\p{IsCyrillic}$"), F.substring(F.lit("абвгдежзиклмнопрстуфхцчш"), _byte(i) % 24 + 1, F.lit(1)))
                       .when(c.rlike(r"^\p{IsGreek}$"), F.substring(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), _byte(i) % 24 + 1, F.lit(1)))
                       .when(c.rlike(r"^\p{L}$"), F.chr((97 + _byte(i) % 26).cast("int")))
                       .otherwise(F.lit("")))
    text = F.array_join(out, "")
    return F.concat(text, F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.chr((97 + _byte(200 + i) % 26).cast("int"))), "")) if loose else text


def _octets(loose: bool) -> Column:
    def octet(o, i):
        n = F.lit(3) if loose else F.length(o)
        return F.when(n == 1, _byte(i) % 10).when(n == 2, 10 + _byte(i) % 90).otherwise(100 + _byte(i) % 156).cast("string")
    return F.array_join(F.transform(F.split("norm", r"\."), octet), ".")


def _checked() -> Column:
    """A card number with its first digit kept and the check digit set."""
    body = F.concat(F.substring("norm", 1, 1), F.expr("substring(plain, 2, length(plain) - 2)"))
    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), lambda d, i:
                        F.when(i % 2 == 0, F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int"))),
                        F.lit(0), lambda a, x: a + x)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _invented(draw: int) -> Column:
    """A name of the part's script; given names end by gender."""
    count = 2 + draw // FREE_AFTER

    def of(script):
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        stem = F.concat(*[F.element_at(syllables, (_byte(F.lit(2 * i)) * 256 + _byte(F.lit(2 * i + 1))) % len(SYLLABLES[script]) + 1) for i in range(count)])
        end = lambda g: F.element_at(F.array(*[F.lit(e) for e in ENDINGS[script][g]]), _byte(F.lit(99)) % 4 + 1)
        either = F.when(_byte(F.lit(98)) % 2 == 0, end("m")).otherwise(end("f"))
        return F.concat(stem, F.when(F.col("type") == "given_f", end("f")).when(F.col("type") == "given_m", end("m"))
                               .when(F.col("type") == "given_n", either).otherwise(end("s")))
    out = of("latin")
    for script, pattern in SCRIPT_OF.items():
        out = F.when(F.regexp_replace("norm", "^given_.:", "").rlike(pattern), of(script)).otherwise(out)
    return out


def drawn(parts: DataFrame, key: str, draw: int) -> DataFrame:
    """Adds the candidate ``surrogate`` to distinct parts ``type, norm, said``."""
    loose = draw >= FREE_AFTER
    out = parts.withColumn("stream", _stream(key, draw)) \
               .withColumn("plain", _spelled(
                   F.when(F.col("type").isin("card", "social"), F.col("norm")).when(F.col("type") == "phone", F.regexp_replace("said", r"\D", ""))
                    .otherwise(F.col("said")), loose))
    return out.withColumn("surrogate", F.when(F.col("type") == "ip", _octets(loose)).when(F.col("type") == "card", _checked())
                          .when(F.col("type").startswith("given") | (F.col("type") == "surname"), _invented(draw))
                          .otherwise(F.col("plain"))).drop("stream", "plain")


def surrogates(parts: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``type, norm, surrogate`` for every distinct part: distinct within a type
    and equal to no value that occurs."""
    todo = scratch.keep(parts.groupBy("type", "norm").agg(F.min("said").alias("said")), "parts")
    taken = todo.select("type", F.lower(F.regexp_replace("said", r"[^\p{L}0-9]", "")).alias("seen")).distinct()
    done: list[DataFrame] = []
    draw = 0
    while not todo.isEmpty():
        cand = scratch.keep(drawn(todo, key, draw).withColumn("seen", F.lower(F.regexp_replace("surrogate", r"[^\p{L}0-9]", ""))), f"draw{draw}")
        first = cand.groupBy("type", "seen").agg(F.min("norm").alias("norm"))
        good = cand.join(first, ["type", "seen", "norm"], "left_semi").join(taken, ["type", "seen"], "left_anti")
        good = scratch.keep(good.select("type", "norm", "surrogate", "seen"), f"good{draw}")
        done.append(good)
        taken = taken.unionByName(good.select("type", "seen"))
        todo = cand.join(good, ["type", "norm"], "left_anti").select("type", "norm", "said")
        draw += 1
    out = done[0] if done else todo.select("type", "norm", F.lit("").alias("surrogate"), F.lit("").alias("seen"))
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("type", "norm", "surrogate")


def _fitted() -> tuple[Column, Column]:
    """Letters and digits of ``surrogate`` (to be named ``plain``), and they laid over ``said``: separators and case of the mention."""
    plain = F.regexp_replace("surrogate", r"[^\p{L}0-9]", "")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    step = lambda a, c: F.when(c.rlike(r"^[\p{L}0-9]$"), F.struct(
        (a["at"] + 1).alias("at"),
        F.concat(a["text"], F.when(c.rlike(r"^\p{Lu}$"), F.upper(F.substring(F.col("plain"), a["at"] + 1, F.lit(1))))
                             .otherwise(F.substring(F.col("plain"), a["at"] + 1, F.lit(1)))).alias("text"))) \
        .otherwise(F.struct(a["at"].alias("at"), F.concat(a["text"], c).alias("text")))
    return plain, F.aggregate(F.split("said", ""), state, step)


def _said(held: DataFrame) -> DataFrame:
    """``_row, _at, _part, type, said, norm``: the parts of all entities. Words of
    ``_names`` (``word, type, norm``) are mentions of a name."""
    known = F.element_at(F.filter("_names", lambda x: x["word"] == F.col("value")), 1)
    each = held.select("_row", "_names", F.posexplode("_entities").alias("_at", "value"))
    mention = F.exists("_names", lambda x: x["word"] == F.col("value"))
    each = each.withColumn("kind", F.when(F.coalesce(mention, F.lit(False)), "mention").otherwise(_kind(F.col("value"))))
    named = F.array(F.struct(known["type"].alias("type"), F.col("value").alias("said"), known["norm"].alias("norm")))
    return (each.withColumn("parts", F.when(F.col("kind") == "mention", named).otherwise(_parts(F.col("kind"), F.col("value"))))
                .select("_row", "_at", F.posexplode("parts").alias("_part", "x")).select("_row", "_at", "_part", "x.type", "x.said", "x.norm"))


def _with_mentions(held: DataFrame) -> DataFrame:
    """``held`` with the names that each text gives after a title (``_names``),
    and texts that give one cut again, at the single words of its names too."""
    names = (_said(held).where(F.col("type").startswith("given") | (F.col("type") == "surname")).groupBy(F.col("_row").alias("_named"))
             .agg(F.array_sort(F.collect_set(F.struct(F.col("said").alias("word"), "type", "norm"))).alias("_found")))
    every = held.drop("_names").join(names, F.col("_row") == F.col("_named"), "left").withColumnRenamed("_found", "_names").drop("_named")
    words = F.array_join(F.transform("_names", lambda x: x["word"]), "|")          # letters only
    # one pattern per text: a regular expression is compiled anew where names differ
    named = found(every.where("_names is not null"), F.concat(F.lit(f"({ENTITY}|(?<!\\p{{L}})(?:"), words, F.lit(")(?!\\p{L}))")))
    return every.where("_names is null").unionByName(named)


def replaced(docs: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``n_entities``."""
    columns = [c for c in docs.columns if c != "n_entities"]
    rest = F.struct(*[F.col(c) for c in columns if c != "text"]) if len(columns) > 1 else F.struct(F.lit(1).alias("_"))
    docs = docs.select(rest.alias("_rest"), F.col("text").cast("string").alias("text"))
    back = [F.col("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in columns]
    hinted = F.col("text").rlike(HINT)
    held = found(docs.where(hinted)).where(F.size("_entities") > 0).withColumn("_row", F.monotonically_increasing_id())
    held = scratch.keep(held.withColumn("_names", F.lit(None).cast("array<struct<word:string,type:string,norm:string>>")), "held")
    held = scratch.keep(_with_mentions(held).drop("text"), "mentions")
    said = scratch.keep(_said(held), "said")
    table = scratch.keep(surrogates(said.where("norm is not null"), key, scratch), "surrogates")
    plain, laid = _fitted()
    named = F.col("type").startswith("given") | (F.col("type") == "surname")
    mapped = (said.where("norm is not null").join(table, ["type", "norm"]).withColumn("plain", plain).withColumn("laid", laid)
                  .withColumn("put", F.when(F.col("type") == "ip", F.col("surrogate"))
                              .when(named, F.when(F.col("said").rlike(r"^\p{Lu}"), F.initcap("surrogate")).otherwise(F.col("surrogate")))
                              .otherwise(F.concat(F.col("laid.text"), F.expr("substring(plain, laid.at + 1)"))))
                  .select("_row", "_at", "_part", "put")
                  .unionByName(said.where("norm is null").select("_row", "_at", "_part", F.col("said").alias("put"))))
    whole = mapped.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", "_part", "put"))).alias("puts"))
    out = held.join(whole, "_row")
    text = F.array_join(F.transform("_pieces", lambda p, i: F.concat(p, F.array_join(F.transform(
        F.filter("puts", lambda x: x["_at"] == i), lambda x: x["put"]), ""))), "")
    changed = out.withColumn("text", text).select(*back, F.size("_entities").alias("n_entities"))
    none = F.col("text").isNull() | ~hinted | (F.size(F.regexp_extract_all("text", F.lit(f"({ENTITY})"), F.lit(1))) == 0)
    return docs.where(F.coalesce(none, F.lit(True))).select(*back, F.lit(0).alias("n_entities")).unionByName(changed)
