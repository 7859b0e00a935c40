"""Personal data: detection and keyed surrogates, in DataFrame functions only.

Entities are found by one pattern: e-mail addresses, IPv4 addresses, card and
social security numbers, phone numbers, credentials, and names after a title.
An entity is identified by its type and its plain form (digits of a number, an
address without case, a name part with the gender of its title), so mentions
that are written differently get the same surrogate.

Surrogates come from SHA-512 of key, type, plain form and attempt:

* numbers and credentials keep their format; every digit or letter becomes
  another of its class (hex stays hex);
* an IPv4 address becomes one in 10/8, an e-mail address a local part of the
  same format under the reserved top-level domain ``example``;
* each part of a name is built of syllables of its script (Latin, Cyrillic),
  a given name with an ending of the title's gender; title and case stay.

Collision checks run over the whole corpus: no two entities may share a surrogate
and none may equal a real entity of its type.  The entity of least hash keeps a contested
surrogate, the others draw again until all differ, so coreference and
distinctness both hold.

Cases: null text stays null, empty text stays empty, both with no entities; rows that
repeat a doc_id get the same surrogates; a null doc_id is handled like any other;
very long texts are rebuilt piece by piece; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Sir", "Don", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Lady", "Doña", "Госпожа")

_TITLE = "(?:" + "|".join(sorted(MALE + FEMALE, key=len, reverse=True)) + ")"
_LOCAL = r"[\p{L}\p{N}._%+\-]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: In this order; the first that matches at a place wins.
PATTERNS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{{2,}}",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "card": r"(?<!\d)\d{4}([ \-]?)\d{4}\1\d{4}\1\d{1,7}(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)|(?<![\d.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])",
    "secret": r"(?<=(?i:token|secret|password|passwd|api.?key)\s{0,3}[:=]\s{0,3}[\"']?)[A-Za-z0-9_+/\-]{8,}={0,2}|(?<![A-Za-z0-9])(?:(?=[0-9a-f]*\d)[0-9a-f]{32,}|(?=[0-9A-F]*\d)[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9\-]{20,})(?![A-Za-z0-9])",
    "name": rf"(?<!\p{{L}}){_TITLE}\.? \p{{Lu}}\p{{Ll}}+(?:[ \-]\p{{Lu}}\p{{Ll}}+){{0,2}}",
}
ANY = "|".join(PATTERNS.values())
#: Texts without a digit, an at sign, an equals sign, a colon or a title hold no entity.
QUICK = rf"[\p{{Nd}}@=:]|{_TITLE}\.? \p{{Lu}}"

_LATIN = "ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ra re sa se ta te".split()
_CYRILLIC = "ба бе би бо да де ди до фа фе га ге ка ке ки ко ла ле ли ло ма ме ми мо на не ра ре са се та те".split()
_ENDINGS = {"m": ("n", "н"), "f": ("lina", "лина"), "s": ("ner", "нов")}


def _hash(key: str, kind: Column, plain: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, plain, attempt.cast("string")), 512)


def _draw(h: Column, place: Column, n: int | Column) -> Column:
    """Number below n from the hash, by place (a 120-place cycle of three hex digits)."""
    at = (place % F.lit(120)).cast("int") + 1
    return (F.conv(F.substr(h, at, F.lit(3)), 16, 10).cast("int") + F.floor(place / F.lit(120)).cast("int")) % n


def _letters(text: Column, h: Column, hex_only: Column) -> Column:
    """Same format, other digits and letters."""

    def swap(c: Column, i: Column) -> Column:
        low = F.translate(F.lower(c), "0123456789", "0000000000")
        return (
            F.when(hex_only & c.rlike("[0-9a-f]"), F.lower(F.hex(_draw(h, i, 16))))
            .when(hex_only & c.rlike("[A-F]"), F.hex(_draw(h, i, 16)))
            .when(low == "0", _draw(h, i, 10).cast("string"))
            .when(c.rlike("[A-Z]"), F.char(F.lit(65) + _draw(h, i, 26)))
            .when(c.rlike("\\p{L}"), F.char(F.lit(97) + _draw(h, i, 26)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, "(?!^)(?!$)"), swap), "")


def _digits(plain: Column, h: Column) -> Column:
    """As many other digits, the first not 0."""

    def swap(c: Column, i: Column) -> Column:
        return F.when(i == 0, F.lit(1) + _draw(h, i, 9)).otherwise(_draw(h, i, 10)).cast("string")

    return F.array_join(F.transform(F.split(plain, "(?!^)(?!$)"), swap), "")


def _name_part(kind: Column, plain: Column, h: Column, attempt: Column) -> Column:
    cyrillic = plain.rlike("\\p{IsCyrillic}")
    table = lambda t: F.array(*[F.lit(s) for s in t])
    syllables = F.when(cyrillic, table(_CYRILLIC)).otherwise(table(_LATIN))
    count = F.lit(3) + F.floor(attempt / F.lit(4)).cast("int")
    body = F.array_join(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.element_at(syllables, _draw(h, i * 3, 32) + 1)), "")
    ending = F.lit("")
    for code, (latin, other) in _ENDINGS.items():
        ending = F.when(kind == f"name-{code}", F.when(cyrillic, F.lit(other)).otherwise(F.lit(latin))).otherwise(ending)
    return F.initcap(F.concat(body, ending))


def core(key: str, kind: Column, plain: Column, attempt: Column) -> Column:
    """Surrogate of a plain form: what replaces it, before format and case."""
    h = _hash(key, kind, plain, attempt)
    octets = F.concat_ws(".", F.lit("10"), *[_draw(h, F.lit(3 * i), 254).cast("string") for i in (1, 2, 3)])
    local = _letters(F.substring_index(plain, "@", 1), h, F.lit(False))
    domain = F.array_join(F.transform(F.sequence(F.lit(60), F.lit(67)), lambda i: F.char(F.lit(97) + _draw(h, i, 26))), "")
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), domain, F.lit(".example")))
        .when(kind == "ip", octets)
        .when(kind == "number", _digits(plain, h))
        .when(kind == "secret", _letters(plain, h, plain.rlike("^([0-9a-f]+|[0-9A-F]+)$")))
        .otherwise(_name_part(kind, plain, h, attempt))
    )


def _kind(entity: Column) -> Column:
    title = F.regexp_extract(entity, rf"^({_TITLE})\.? \p{{Lu}}\p{{Ll}}", 1)
    return (
        F.when(F.contains(entity, F.lit("@")), F.lit("email"))
        .when(title.isin(*MALE), F.lit("name-m"))
        .when(title.isin(*FEMALE), F.lit("name-f"))
        .when(entity.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), F.lit("ip"))
        .when(entity.rlike("[A-Za-z_/=]"), F.lit("secret"))
        .when(entity.rlike("^[\\d ().+\\-]{7,}$") & (F.length(F.regexp_replace(entity, "\\D", "")) < 32), F.lit("number"))
        .otherwise(F.lit("secret"))
    )


def _parts(entity: Column) -> Column:
    """Array of (kind, plain): one for most entities, one per part of a name.
    The last of several parts is a family name, which has no gender."""
    kind = _kind(entity)
    plain = F.when(kind == "email", F.lower(entity)).when(kind == "number", F.regexp_replace(entity, "\\D", "")).otherwise(entity)
    names = F.split(F.regexp_replace(entity, rf"^{_TITLE}\.? ", ""), "[ \\-]")
    of_name = F.transform(names, lambda p, i: F.struct(F.when(i == F.size(names) - 1, F.lit("name-s")).otherwise(kind).alias("kind"), p.alias("plain")))
    return F.when(kind.startswith("name"), of_name).otherwise(F.array(F.struct(kind.alias("kind"), plain.alias("plain"))))


def entities(text: Column) -> Column:
    """All entities of a text, in order."""
    return F.when(text.rlike(QUICK), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, plain, core) for all distinct (kind, plain), collision-free."""
    found = stored(found.select("kind", "plain").distinct(), "pii-entities")
    order = F.struct((F.col("attempt") >= 0).cast("int"), F.xxhash64("plain"), F.col("plain"))
    settled, pending = None, found.withColumn("attempt", F.lit(0))
    while True:
        # settled ones keep theirs (attempt -1); a real plain form of the kind is taken
        drawn = pending.withColumn("core", core(key, F.col("kind"), F.col("plain"), F.col("attempt")))
        every = drawn if settled is None else drawn.unionAll(settled.withColumn("attempt", F.lit(-1)).select(*drawn.columns))
        real = found.select("kind", F.col("plain").alias("core"), F.lit(True).alias("real"))
        owner = every.groupBy("kind", "core").agg(F.min_by("plain", order).alias("owner"))
        judged = every.join(owner, ["kind", "core"]).join(real, ["kind", "core"], "left")
        good = (F.col("owner") == F.col("plain")) & F.col("real").isNull()
        judged = stored(judged.withColumn("good", good).select("kind", "plain", "attempt", "core", "good"), "pii-surrogates")
        settled = judged.where("good").select("kind", "plain", "core")
        pending = judged.where("NOT good").select("kind", "plain", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return settled


def _fill(entity: Column, cores: Column) -> Column:
    """An entity in its own format with the cores of its parts."""
    one = F.element_at(cores, 1)
    chars = F.split(entity, "(?!^)(?!$)")
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(acc: Column, c: Column) -> Column:
        digit = c.rlike("\\d")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substr(one, acc["k"], F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + digit.cast("int")).alias("k"))

    number = F.aggregate(chars, state, put, lambda acc: acc["out"])
    kind = _kind(entity)
    title = F.regexp_extract(entity, rf"^({_TITLE}\.? )", 1)
    gaps = F.regexp_extract_all(F.regexp_replace(entity, rf"^{_TITLE}\.? ", ""), F.lit("[ \\-]"), F.lit(0))
    name = F.concat(title, F.array_join(F.transform(cores, lambda c, i: F.concat(c, F.coalesce(F.get(gaps, i), F.lit("")))), ""))
    mail = F.when(entity == F.upper(entity), F.upper(one)).otherwise(one)
    return F.when(kind == "number", number).when(kind == "email", mail).when(kind.startswith("name"), name).otherwise(one)


def replace(docs: DataFrame, key: str = "surrogate-key") -> DataFrame:
    """doc_id, text with surrogates, n_entities."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = stored(docs.select("doc_id", entities(F.col("text")).alias("found")).where(F.size("found") > 0), "pii-found")
    parts = hits.select("doc_id", F.explode(F.array_distinct("found")).alias("e")).select("doc_id", "e", F.posexplode(_parts(F.col("e"))).alias("i", "p")).select("doc_id", "e", "i", "p.kind", "p.plain")
    known = surrogates(parts, key)
    filled = parts.join(known, ["kind", "plain"]).groupBy("doc_id", "e").agg(F.transform(F.sort_array(F.collect_set(F.struct("i", "core"))), lambda x: x["core"]).alias("cores"))
    filled = filled.select("doc_id", "e", _fill(F.col("e"), F.col("cores")).alias("s"))
    maps = filled.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("e", "s"))).alias("swap"))  # bounded by the document
    joined = docs.join(maps.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    found = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    between = F.split("text", ANY, -1)
    # pieces and surrogates by turns
    body = F.array_join(F.transform(between, lambda piece, i: F.concat(piece, F.coalesce(F.element_at(F.col("swap"), F.get(found, i)), F.lit("")))), "")
    swapped = F.col("swap").isNotNull()
    n = F.when(swapped, F.size(found)).otherwise(0).cast("long")
    return joined.select("doc_id", F.when(swapped, body).otherwise(F.col("text")).alias("text"), n.alias("n_entities"))


def op10_pii(docs: DataFrame) -> DataFrame:
    return replace(docs)
