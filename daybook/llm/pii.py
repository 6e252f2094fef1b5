"""PII (8, DataFrame functions only): surrogate generation.

Entities (mail addresses, phone numbers, card numbers, IP addresses, national
ids, bank accounts, titled names) are found by fixed patterns. Every distinct
entity, in a canonical form, gets a replacement drawn from a keyed digest: of
the same kind and format, letters of the same script and case, card numbers
with a valid check digit, names of the title's gender. Replacements that two
entities share, or that occur as an entity themselves, are drawn again until
none is left, so distinct entities stay distinct and every mention of one
entity, in any spelling, becomes the same replacement everywhere.

A name is a surname and perhaps a first name, replaced apart: all mentions of
a surname get one replacement, so "Mr John Smith", "Dr Smith" and "John Smith"
stay one person, and first names are told apart among people of one surname.
Where a document has a titled name, its full name and its surname are replaced
without a title too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import broadcast_if_small, stored

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
_TITLES = {"m": ("Mr", "Herr", "Sr", "Señor", "Monsieur"), "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Sra", "Señora", "Madame"), "n": ("Dr", "Prof")}
_TITLE = "|".join(t for g in _TITLES.values() for t in sorted(g, key=len, reverse=True))
#: Kind -> pattern, tried in this order at every place of a text.
PATTERNS = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}][\p{{L}}\p{{M}}\p{{N}}._%+-]*+@{_LABEL}(?:\.{_LABEL})+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![A-Za-z0-9+/_=.-])(?:\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{13,19})(?![A-Za-z0-9+/_=])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text must hold for the kinds of a group to match anywhere: cheap to look for.
_GROUPS = {"@": ("email",), "[0-9]": ("iban", "ip", "phone", "ssn", "card"), rf"(?:{_TITLE})\.? \p{{Lu}}": ("name",)}
_TITLED = rf"^(?:{_TITLE})\.? "
#: Times that replacements are drawn before the kind's format counts as full.
MOST_ATTEMPTS = 32
#: Entities whose replacements one task draws.
TASK_ENTITIES = 2_000

#: Alphabets that replace a letter or digit of theirs, in this order.
_ALPHABETS = (
    ("[0-9]", "0123456789"),
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"[\p{IsLatin}&&\p{Ll}]", "àáâäçèéêëíîïñóôöùúûü"),
    (r"[\p{IsLatin}&&\p{Lu}]", "ÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"),
    (r"[\p{IsCyrillic}&&\p{Ll}]", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"[\p{IsGreek}&&\p{Ll}]", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"),
)
_FIRST = {
    ("m", "Latin"): "Adam Boris Carl David Emil Felix Georg Henry Ivan Jonas Karl Leon Martin Noah Oscar Paul Robert Simon Thomas Victor",
    ("f", "Latin"): "Alice Bianca Clara Diana Emma Flora Greta Hanna Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera",
    ("n", "Latin"): "Alex Andrea Chris Dominique Eden Jamie Jordan Kim Lee Morgan Noel Quinn Robin Sasha Toni",
    ("m", "Cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Олег Павел Роман",
    ("f", "Cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Мария Ольга Полина Софья",
    ("n", "Cyrillic"): "Женя Саша Валя Слава",
    ("m", "Greek"): "Αλέξης Γιάννης Δημήτρης Κώστας Νίκος Πέτρος",
    ("f", "Greek"): "Άννα Ελένη Ειρήνη Μαρία Σοφία Κατερίνα",
    ("n", "Greek"): "Άγγελος Χαρά",
}
_SYLLABLES = {
    "Latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wa ze zo li".split(),
    "Cyrillic": "ба во га де зо ка ле ма не по ра со та фе хо ша ли ни ри ти".split(),
    "Greek": "βα γο δε ζα κο λα με νο πα ρο σα τε φο χα λι νι".split(),
}


def _byte(h: Column, i) -> Column:
    """The ``i``-th byte (from 0, over and over) of the hex digest ``h``."""
    at = F.pmod(i, F.lit(96)) * 2 + 1
    return 16 * _nibble(h, at) + _nibble(h, at + 1)


def _nibble(h: Column, at) -> Column:
    return F.instr(F.lit("0123456789abcdef"), F.substr(h, at.cast("int"), F.lit(1))) - 1


def _pick(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (n % len(words) + 1).cast("int"))


def _syllable(parts: list[str], h: Column):
    return lambda i: _pick(parts, _byte(h, i + 4) * 256 + _byte(h, i + 20))


def _redraw(value: Column, h: Column) -> Column:
    """``value`` with every letter and digit drawn anew from its own alphabet."""

    def char(c: Column, i: Column) -> Column:
        out = c
        for pattern, letters in reversed(_ALPHABETS):
            pos = (_byte(h, i) * 7 + _byte(h, i + 41)) % len(letters) + 1
            out = F.when(c.rlike(f"^{pattern}$"), F.substr(F.lit(letters), pos.cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(value, ""), char), "")


def _luhn(body: Column) -> Column:
    """Check digit of a digit string: the last position is doubled first."""
    digits = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return ((10 - F.aggregate(digits, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")


def _gender(title: Column) -> Column:
    out = F.lit("n")
    for g in ("m", "f"):
        out = F.when(title.isin(*_TITLES[g]), g).otherwise(out)
    return out


def found_in(text: Column) -> Column:
    """All mentions of a text, in order; the patterns that cannot match anywhere in it are not tried."""
    out = F.array().cast("array<string>")
    for n in range(1, 1 << len(_GROUPS)):
        held = [k for i, k in enumerate(_GROUPS) if n >> i & 1]
        kinds = [k for k in PATTERNS if any(k in _GROUPS[g] for g in held)]
        pattern = "|".join(f"(?:{PATTERNS[k]})" for k in kinds)
        here = F.lit(True)
        for g in held:
            here = here & (text.contains(g) if g == "@" else text.rlike(g))
        out = F.when(here, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(out)
    return out


def name_words(value: Column) -> Column:
    """The words of a name without its title."""
    return F.split(F.regexp_replace(value, _TITLED, ""), " ")


def untitled(values: Column) -> Column:
    """A pattern of the full names and surnames of the titled names in ``values``, null where there is none."""
    names = F.filter(values, lambda v: v.rlike(_TITLED))
    said = F.array_distinct(F.flatten(F.transform(names, lambda v: F.array(F.array_join(name_words(v), " "), F.element_at(name_words(v), -1)))))
    longest = F.array_sort(said, lambda a, b: F.length(b) - F.length(a))
    return F.when(F.size(names) > 0, F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(longest, "|"), F.lit(r")(?!\p{L})")))


def kind_of(value: Column) -> Column:
    out = F.lit("card")
    for kind in reversed(("email", "iban", "ip", "phone", "ssn", "name")):
        shape = {"email": "@", "iban": r"^[A-Z]{2}\d{2}", "ip": rf"^(?:{_OCTET}\.){{3}}{_OCTET}$", "phone": r"^\+|^\(|^\d{3}-\d{3}-\d{4}$", "ssn": r"^\d{3}-\d{2}-\d{4}$", "name": r"^\p{L}+(?:\.? \p{L}|$)"}[kind]
        out = F.when(value.rlike(shape), kind).otherwise(out)
    return out


def canonical(kind: Column, value: Column) -> Column:
    """The form in which two mentions are the same entity (of all kinds but names)."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind.isin("card", "ssn"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "phone", F.regexp_replace(value, r"[^\d+]", ""))
        .otherwise(value)
    )


def draw(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """A replacement of the canonical form: same kind, format, script and gender.

    Surnames and the parts of mail addresses get longer with every attempt, so there is always room for them.
    The canonical form of a first name is ``gender:first:surname``.
    """

    def digest(what: Column) -> Column:
        return F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(n)), kind, attempt.cast("string"), what), 256) for n in range(3)])

    h = digest(canon)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    site = F.regexp_replace(domain, r"\.[^.]*$", "")
    site_h = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"site{n}"), domain), 256) for n in range(3)])
    # Addresses of one domain stay together; a longer local part keeps apart what falls together.
    longer = F.concat(local, F.repeat(F.lit("a"), attempt))
    mail = F.concat(_redraw(longer, h), F.lit("@"), _redraw(site, site_h), F.lit(".example"))
    octet = lambda i, most: ((_byte(h, F.lit(i)) * 256 + _byte(h, F.lit(i + 9))) % most + 1).cast("string")
    ip = F.concat_ws(".", octet(0, 223), octet(1, 254), octet(2, 254), octet(3, 254))
    digits = _redraw(canon, h)
    body = F.concat(F.lit("4"), F.substr(digits, F.lit(2), F.length(canon) - 2))
    country = F.regexp_extract(canon, r"^(\+\d|)", 1)
    phone = F.concat(country, F.substr(digits, F.length(country) + 1, F.length(canon)))
    ssn = F.concat(F.lit("9"), F.substr(digits, F.lit(2), F.lit(8)))
    iban = F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(digits, F.lit(3), F.length(canon)))
    gender, word = F.substr(canon, F.lit(1), F.lit(1)), F.when(kind == "first", F.split_part(canon, F.lit(":"), F.lit(2))).otherwise(canon)
    script = F.when(word.rlike(r"\p{IsCyrillic}"), "Cyrillic").when(word.rlike(r"\p{IsGreek}"), "Greek").otherwise("Latin")
    first, last = F.lit(""), F.lit("")
    for (g, s), names in _FIRST.items():
        first = F.when((gender == g) & (script == s), _pick(names.split(), _byte(h, F.lit(0)) * 256 + _byte(h, F.lit(1)))).otherwise(first)
    for s, parts in _SYLLABLES.items():
        made = F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), attempt + 3), _syllable(parts, h)), ""))
        last = F.when(script == s, made).otherwise(last)
    # The first names of the lists come first; where two fall together, the next one is made like a surname.
    first = F.when(attempt < 1, first).otherwise(last)
    return (
        F.when(kind == "email", mail).when(kind == "ip", ip).when(kind == "card", F.concat(body, _luhn(body))).when(kind == "phone", phone)
        .when(kind == "ssn", ssn).when(kind == "iban", iban).when(kind == "first", first).otherwise(last)
    )


def spelled(kind: Column, value: Column, replacement: Column) -> Column:
    """The canonical replacement in the format of the mention ``value``."""
    plain = F.when(kind == "phone", F.replace(replacement, F.lit("+"), F.lit(""))).otherwise(replacement)

    def char(c: Column, i: Column) -> Column:
        before = F.substr(value, F.lit(1), (i + 1).cast("int"))
        nth = F.when(kind == "iban", F.length(F.regexp_replace(before, "[^A-Z0-9]", ""))).otherwise(F.length(F.regexp_replace(before, "[^0-9]", "")))
        fills = F.when(kind == "iban", c.rlike("^[A-Z0-9]$")).otherwise(c.rlike("^[0-9]$"))
        return F.when(fills, F.substr(plain, nth, F.lit(1))).otherwise(c)

    filled = F.array_join(F.transform(F.split(value, ""), char), "")
    upper = (F.upper(value) == value) & (F.lower(value) != value)
    return (
        F.when(kind == "email", F.when(upper, F.upper(replacement)).otherwise(replacement))
        .when(kind == "ip", replacement)
        .otherwise(filled)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, replacement)`` for distinct ``(kind, canon)``, no two alike and none an entity itself.

    First names are told apart among those of one surname. It ends: what falls together is drawn again, from a
    larger space each time for names and addresses; in the fixed formats (numbers, first names of the lists) less
    than half of the rest falls together again as long as half of the format is free, and where
    ``MOST_ATTEMPTS`` draws do not do, the format is full and that is an error.
    """
    scope = F.when(F.col("kind") == "first", F.split_part("canon", F.lit(":"), F.lit(3))).otherwise(F.lit(""))
    itself = F.when(F.col("kind") == "first", F.split_part("canon", F.lit(":"), F.lit(2))).otherwise(F.col("canon"))
    tasks = max(1, -(-entities.count() // TASK_ENTITIES))
    entities = entities.select("kind", "canon").repartition(tasks, "kind", "canon")
    real = stored(entities.select("kind", scope.alias("scope"), itself.alias("replacement")).distinct().withColumn("real", F.lit(True)), "real")
    now = entities.select("kind", "canon", F.lit(0).alias("attempt"))
    for _ in range(MOST_ATTEMPTS):
        drawn = now.withColumn("replacement", draw(F.col("kind"), F.col("canon"), F.col("attempt"), key)).withColumn("scope", scope)
        nth = F.row_number().over(Window.partitionBy("kind", "scope", "replacement").orderBy("attempt", "canon"))
        checked = stored(drawn.withColumn("nth", nth).join(real, ["kind", "scope", "replacement"], "left"), "checked")
        again = (F.col("nth") > 1) | F.coalesce("real", F.lit(False))
        if checked.where(again).isEmpty():
            return checked.select("kind", "canon", "replacement")
        now = checked.select("kind", "canon", F.when(again, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"))
        now = now.repartition(tasks, "kind", "canon")
    raise RuntimeError(f"{MOST_ATTEMPTS} draws leave entities that share a replacement: their format has no room")


def name_parts(names: DataFrame) -> DataFrame:
    """``(value, title, first, last, canon)`` of name mentions: the words, and the canonical first name.

    A full name has the gender of its titles wherever it occurs, and none where they differ or say nothing.
    """
    words = name_words(F.col("value"))
    title = F.regexp_extract("value", _TITLED, 0)
    parts = names.select("value", title.alias("title"), F.when(F.size(words) > 1, words[0]).alias("first"), F.element_at(words, -1).alias("last"))
    said = _gender(F.regexp_extract("title", r"^(\p{L}+)", 1))
    genders = parts.where("first IS NOT NULL").withColumn("g", F.when(said != "n", said)).groupBy("first", "last").agg(F.min("g").alias("low"), F.max("g").alias("high"))
    gender = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("n")
    genders = genders.select("first", "last", F.concat_ws(":", gender, F.col("first"), F.col("last")).alias("canon"))
    return parts.join(genders, ["first", "last"], "left").select("value", "title", "first", "last", "canon")


def replacements(values: DataFrame, key: str) -> DataFrame:
    """``(value, said)``: what each distinct mention ``value`` becomes."""
    kinds = values.select("value", kind_of(F.col("value")).alias("kind"))
    plain = stored(kinds.where("kind <> 'name'").withColumn("canon", canonical(F.col("kind"), F.col("value"))), "values")
    names = stored(name_parts(kinds.where("kind = 'name'")), "names")
    entities = plain.select("kind", "canon").unionByName(names.select(F.lit("surname").alias("kind"), F.col("last").alias("canon")))
    entities = entities.unionByName(names.where("canon IS NOT NULL").select(F.lit("first").alias("kind"), "canon"))
    drawn = stored(surrogates(stored(entities.distinct(), "entities"), key), "surrogates")
    said = plain.join(drawn, ["kind", "canon"]).select("value", spelled(F.col("kind"), F.col("value"), F.col("replacement")).alias("said"))
    firsts = drawn.where("kind = 'first'").select("canon", F.col("replacement").alias("new_first"))
    lasts = drawn.where("kind = 'surname'").select(F.col("canon").alias("last"), F.col("replacement").alias("new_last"))
    people = names.join(firsts, "canon", "left").join(lasts, "last")
    whole = F.concat(F.col("title"), F.coalesce(F.concat("new_first", F.lit(" ")), F.lit("")), F.col("new_last"))
    return said.unionByName(people.select("value", whole.alias("said")))


def replace_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = "surrogate-key") -> DataFrame:
    """``(doc_id, text, n_entities)`` per row: the text with every entity replaced.

    A null text stays null and has no entities; equal rows all come back; a null id is kept.
    ``key`` fixes all replacements: the same key and entities give the same ones.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    held = rows.where("text IS NOT NULL").select("doc_id", "text", digest.alias("digest"), found_in(F.col("text")).alias("titled"))
    held = held.where(F.size("titled") > 0).withColumn("more", untitled(F.col("titled")))
    again = F.concat_ws("|", F.lit(ANY), F.col("more"))
    found = F.when(F.col("more").isNull(), F.col("titled")).otherwise(F.regexp_extract_all("text", again, F.lit(0)))
    held = stored(held.select("doc_id", "digest", "more", F.array_distinct(found).alias("values")).distinct(), "held")
    values = stored(held.select(F.explode("values").alias("value")).distinct(), "values")
    said = stored(replacements(values, key), "said")
    # A value that many documents hold meets one row here, so its documents need no shuffle of texts.
    small = broadcast_if_small(said, size=F.length("value") + F.length("said") + 32)
    each = held.select("doc_id", "digest", "more", F.explode("values").alias("value")).join(small, "value")
    maps = each.groupBy(F.struct("doc_id", "digest").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct("value", "said"))).alias("said"), F.first("more").alias("more"))
    maps = stored(maps, "maps")
    wide = F.coalesce(F.length("more"), F.lit(0)) + F.aggregate(F.map_entries("said"), F.lit(48), lambda n, e: n + F.length(e["key"]) + F.length(e["value"]) + 32)
    out = rows.withColumn("row", F.struct("doc_id", digest.alias("digest"))).join(broadcast_if_small(maps, size=wide), "row", "left")
    mentions = F.when(F.col("said").isNotNull(), F.regexp_extract_all("text", again, F.lit(0)))
    parts = F.split(F.col("text"), again, F.lit(-1))
    new = F.array_join(
        F.flatten(F.zip_with(parts, mentions, lambda p, m: F.array(F.coalesce(p, F.lit("")), F.coalesce(F.element_at(F.col("said"), m), F.lit(""))))), ""
    )
    return out.select("doc_id", F.when(mentions.isNull(), F.col("text")).otherwise(new).alias("text"), F.when(mentions.isNull(), 0).otherwise(F.size(mentions)).cast("long").alias("n_entities"))
