"""Personal data replaced by surrogates, with DataFrame functions only.

Detected are emails, secrets after a key word, IBANs, card numbers, social security numbers, phone numbers, IP addresses and
names after a title. Entities are replaced whole, secrets of any length included. Each entity has a canonical form (digits of a number, lower case of an email), so all ways to write
it share one surrogate: coreference holds over the whole corpus. A name that stands after a title somewhere in a document is also found
without it in that document, as the full name and as the surname alone. Surrogates come from a keyed hash of kind and canonical
form, letter for letter and digit for digit: scripts (Latin, Greek, Cyrillic), case and separators stay, names are drawn
from lists of their script and gender, cards keep a valid check digit if they had one, octets stay octets, and emails end in
a reserved domain.

Distinctness is checked over the corpus: entities whose surrogates meet, or equal an entity that occurs, are drawn again with
the next salt, until none is left; the first in order keeps the shared one. Only texts with entities are
shuffled, keyed by their list of mentions; a group of copies that holds a third of all rows is split by salt.

Defined results: null texts stay null, texts without entities stay as they are; rows are replaced one by one, repeated rows
alike; an empty table gives an empty table. Other columns stay; ``n_surrogates`` replaces an input column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import once
from pagemill.llm.common import Aside, stored

#: Rows with one list of mentions are dealt to so many keys.
SALTS = 32
#: Draws after which an entity gets a longer surrogate, if its form leaves no free one.
DRAWS = 24
#: Letters of an entity above which its seed is hashed first.
LONG = 256

_MALE_TITLES = r"Mr|Herr|Monsieur|Señor|Sr|Don|Mister|Господин|Κύριος"
_FEMALE_TITLES = r"Mrs|Ms|Miss|Frau|Madame|Mademoiselle|Señora|Señorita|Sra|Doña|Госпожа|Κυρία"
_OTHER_TITLES = r"Dr|Prof|Professor|Professorin|Doktor|Docteur|Doctor|Доктор|Профессор"
_NAME = r"\p{Lu}[\p{L}’'-]{1,40}"

#: Kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,8}\p{L}{2,24}",
    "secret": r"(?i:(?<![a-z])(?:token|password|passwd|secret|api[_-]?key|access[_-]?key)[ \t]{0,4}[=:][ \t]{0,4})[\"']?(?=\S{0,4096}?\d|[\p{L}\p{N}_+/.-]*?\d)[\p{L}\p{N}_+/.-]{6,}+[\"']?",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\d.])(?<!(?i:version|release|revision) )(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "card": r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?\(\d{1,5}\)[ .-]?\d{2,5}(?:[ .-]?\d{2,5})?|\+\d{1,3}(?:[ .-]?(?!\d{1,3}\.\d{1,3}\.\d)\d{2,5}){2,4}|\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}|0\d{2,4}[ /-]\d{3,4}[ -]\d{3,5})(?![\p{L}\p{N}])",
    "male": rf"(?<!\p{{L}})(?:{_MALE_TITLES})\.? {_NAME}(?: {_NAME})?",
    "female": rf"(?<!\p{{L}})(?:{_FEMALE_TITLES})\.? {_NAME}(?: {_NAME})?",
    "person": rf"(?<!\p{{L}})(?:{_OTHER_TITLES})\.? {_NAME}(?: {_NAME})?",
}
#: Kinds of names, by the titles before them.
NAMED = ("male", "female", "person")
ANY = "|".join(PATTERNS.values())
#: What any entity holds; texts without it are not searched.
HINT = rf"@|\d[\d .()-]{{6}}|\d\.\d{{1,3}}\.\d|[A-Z]{{2}}\d{{2}}[A-Z0-9 ]|[=:][ \t]{{0,4}}[\"']?[\p{{L}}\p{{N}}_+/.-]|\+\d|(?:{_MALE_TITLES}|{_FEMALE_TITLES}|{_OTHER_TITLES})\.? \p{{Lu}}"

_ALPHABETS = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "hex": "0123456789abcdef",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя",
}
NAMES = {
    ("male", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karel Louis Marco Nils Oscar Paul Quentin Robert Simon Thomas Urban Victor Walter Xavier".split(),
    ("female", "latin"): "Anna Bianca Clara Diana Elena Flora Greta Helen Irene Julia Karin Laura Maria Nora Olivia Petra Rosa Sara Teresa Ulrike Vera Wanda Xenia Yvonne".split(),
    ("male", "greek"): "Αλέξης Γιώργος Δημήτρης Κώστας Λεωνίδας Νίκος Παύλος Σπύρος".split(),
    ("female", "greek"): "Άννα Βασιλική Ελένη Ζωή Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("male", "cyrillic"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Павел Сергей".split(),
    ("female", "cyrillic"): "Анна Вера Галина Елена Ирина Мария Наталья Ольга Светлана".split(),
}
NAMES |= {("person", script): NAMES["male", script] + NAMES["female", script] for script in ("latin", "greek", "cyrillic")}
SURNAME_PARTS = {
    "latin": ("Bar Cor Dal Fen Gar Hol Kel Lan Mor Nor Par Ros Sel Tor Val Wes".split(), "a e i o u".split(), "bert der ford gren kin land mann ner rin sen ston win".split()),
    "greek": ("Αθ Βασ Γαβ Δημ Καρ Λαμ Μαν Παπ".split(), "α ι ο".split(), "δης κης λος νης πουλος ρας".split()),
    "cyrillic": ("Аб Бел Вор Гор Дан Кар Лаз Мор".split(), "а е и о".split(), "гов ков лов нов ров шин".split()),
}
LINKS = {"latin": list("dlmnrstv"), "greek": list("λμνρτ"), "cyrillic": list("длмнрт")}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


#: Stands before a name that is mentioned without its title, with the kind of the name; no pattern finds it in a text.
_BARE = "\x01"


def kind_of(mention: Column) -> Column:
    """The kind of a mention: the first pattern that fits the whole of it; that of a bare name is written before it."""
    bare = F.regexp_extract(mention, rf"^{_BARE}([a-z]+) ", 1)
    found = F.when(bare != "", bare)
    for kind, pattern in PATTERNS.items():
        fits = mention.rlike(rf"^(?:{pattern})$")
        found = F.when(fits, F.lit(kind)) if found is None else found.when(fits, F.lit(kind))
    return found.otherwise(F.lit("other"))


def parts(mention: Column, kind: Column) -> tuple[Column, Column, Column]:
    """What stands before the entity in a mention (a key word, a title), the entity, and what stands after it."""
    secret = r"(?s)^(.*?[=:][ \t]{0,4}[\"']?)(.*?)([\"']?)$"
    title = r"(?s)^(\S+ )(.*)()$"  # of a bare name what stands before it is its mark
    named = kind.isin(*NAMED)

    def part(k: int) -> Column:
        alone = mention if k == 2 else F.lit("")
        return (
            F.when(kind == "secret", F.regexp_extract(mention, secret, k))
            .when(named, F.regexp_extract(mention, title, k))
            .otherwise(alone)
        )

    return part(1), part(2), part(3)


def canonical(entity: Column, kind: Column) -> Column:
    """One form for all ways to write an entity."""
    return (
        F.when(kind.isin("card", "ssn"), _digits(entity))
        .when(kind == "phone", _digits(entity))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when((kind == "secret") & (entity != F.upper(entity)), entity)
        .otherwise(F.lower(entity))
    )


def _hash_int(seed: Column, place: Column, bound: int) -> Column:
    """A number below ``bound`` from 60 bits of SHA-256 of the seed and a place."""
    digest = F.sha2(F.concat(seed, F.lit("|"), place.cast("string")), 256)
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % bound).cast("int")


def _translated(text: Column, seed: Column) -> Column:
    """Each letter and digit replaced by one of its script and case, the rest kept. The seed decides."""

    def other(c: Column, place: Column) -> Column:
        def pick(alphabet: str) -> Column:
            letters = _ALPHABETS[alphabet]
            return F.substring(F.lit(letters), _hash_int(seed, place, len(letters)) + 1, F.lit(1))

        return (
            F.when(c.rlike(r"^[0-9]$"), pick("digit"))
            .when(c.rlike(r"^\p{Lu}$"), F.when(c.rlike(r"^\p{IsGreek}$"), F.upper(pick("greek"))).when(c.rlike(r"^\p{IsCyrillic}$"), F.upper(pick("cyrillic"))).otherwise(pick("upper")))
            .when(c.rlike(r"^\p{L}$"), F.when(c.rlike(r"^\p{IsGreek}$"), pick("greek")).when(c.rlike(r"^\p{IsCyrillic}$"), pick("cyrillic")).otherwise(pick("lower")))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), other), "")


def _hexadecimal(text: Column, seed: Column) -> Column:
    """As many other hexadecimal digits."""
    return F.array_join(F.transform(F.split(text, ""), lambda c, k: F.when(c == "", c).otherwise(F.substring(F.lit(_ALPHABETS["hex"]), _hash_int(seed, k, 16) + 1, F.lit(1)))), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted once."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, k: F.when(k % 2 == 0, c.try_cast("int")).otherwise((c.try_cast("int") * 2) % 10 + F.floor(c.try_cast("int") * 2 / 10).cast("int")))
    return F.aggregate(places, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _picked(values: list[str], seed: Column, place: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _hash_int(seed, F.lit(place), len(values)) + 1)


def _name(canon: Column, kind: Column, seed: Column) -> Column:
    """Given name of the gender and script, and a surname made from syllables; the given name only where there are two words.

    Each word has its own seed, so a surname alone and in a full name are replaced alike."""
    script, out = _script(canon), None
    two = canon.contains(" ")
    for (gender, of_script), given in NAMES.items():
        first, middle, last = SURNAME_PARTS[of_script]
        of_last, of_first = F.concat(seed, F.substring_index(canon, " ", -1)), F.concat(seed, F.substring_index(canon, " ", 1))
        syllables = (first, middle, LINKS[of_script], middle, last)
        surname = F.concat(*[_picked(values, of_last, f"s{k}") for k, values in enumerate(syllables)])
        value = F.when(two, F.concat(_picked(given, of_first, "g"), F.lit(" "), surname)).otherwise(surname)
        fits = (kind == gender) & (script == of_script)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def surrogate(canon: Column, kind: Column, key: str, draw: Column) -> Column:
    """The surrogate of a canonical form at a draw. It has the canonical form of its kind, too."""
    seed = F.concat(F.lit(key + "|"), kind, F.lit("|"), canon, F.lit("|"), draw.cast("string"))
    seed = F.when(F.char_length(canon) > LONG, F.sha2(seed, 256)).otherwise(seed)  # it is hashed for each letter
    longer = F.when(draw >= DRAWS, F.substring(F.sha2(seed, 256), 1, 12)).otherwise(F.lit(""))
    local = F.regexp_extract(canon, r"^([^@]*)@", 1)
    host = F.regexp_extract(canon, r"@([^.]*)", 1)
    top = F.when(canon.rlike(r"\.org$"), "org").when(canon.rlike(r"\.net$"), "net").otherwise("com")
    email = F.concat(_translated(local, seed), longer, F.lit("@"), _translated(host, F.concat(seed, F.lit("h"))), F.lit(".example."), top)
    octets = F.array_join(F.array(*[(_hash_int(seed, F.lit(k), 254) + 1).cast("string") for k in range(4)]), ".")
    size = F.char_length(canon)
    body = F.concat(F.substring(canon, 1, 1), _translated(F.substring(canon, F.lit(2), size - 2), seed))
    check = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    off = F.when(_luhn_sum(canon) % 10 == 0, F.lit(0)).otherwise(1 + _hash_int(seed, F.lit("c"), 9))
    card = F.concat(body, ((check + off) % 10).cast("string"))
    country = F.least(F.lit(3), F.greatest(F.lit(0), size - 10))
    phone = F.concat(F.substring(canon, F.lit(1), country), _translated(F.substring(canon, country + 1, size), seed))
    iban = F.concat(F.substring(canon, 1, 2), _translated(F.substring(canon, F.lit(3), size), seed))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", octets)
        .when(kind == "card", F.concat(card, longer))
        .when(kind == "phone", F.concat(phone, longer))
        .when(kind == "iban", F.concat(iban, longer))
        .when(kind.isin(*NAMED), F.concat(F.lower(_name(canon, kind, F.concat(F.lit(key + "|"), draw.cast("string"), F.lit("|")))), longer))
        .when(canon.rlike("^[0-9a-f]{16,}$"), F.concat(_hexadecimal(canon, seed), longer))
        .otherwise(F.concat(_translated(canon, seed), longer))
    )


def written(surrogate_: Column, entity: Column, kind: Column) -> Column:
    """A surrogate in the way the entity is written: its separators and case."""
    spaced = F.array_join(
        F.transform(
            F.split(entity, ""),
            lambda c, k: F.when(c.rlike("^[0-9A-Z]$"), F.substring(surrogate_, F.char_length(F.regexp_replace(F.substring(entity, F.lit(1), k + 1), "[^0-9A-Z]", "")), F.lit(1))).otherwise(c),
        ),
        "",
    )
    tail = F.when(
        F.char_length(surrogate_) > F.char_length(F.regexp_replace(entity, "[^0-9A-Z]", "")),
        F.substring(surrogate_, F.char_length(F.regexp_replace(entity, "[^0-9A-Z]", "")) + 1, F.lit(64)),
    ).otherwise(F.lit(""))
    upper = (entity == F.upper(entity)) & (entity != F.lower(entity))
    cased = F.when(upper, F.upper(surrogate_)).when(kind.isin(*NAMED), F.initcap(surrogate_)).otherwise(surrogate_)
    return F.when(kind.isin("card", "ssn", "phone", "iban"), F.concat(spaced, tail)).otherwise(cased)


def _entities(mentions: DataFrame) -> DataFrame:
    """``(mention, kind, before, entity, after, canon)`` of distinct mentions."""
    kinds = mentions.withColumn("kind", kind_of(F.col("mention")))
    before, entity, after = parts(F.col("mention"), F.col("kind"))
    cut = kinds.select("mention", "kind", before.alias("before"), entity.alias("entity"), after.alias("after"))
    return cut.withColumn("canon", canonical(F.col("entity"), F.col("kind")))


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, surrogate)``: distinct within the kind, and none equal to an entity that occurs."""
    wanted = stored(entities.select("kind", "canon").distinct(), "pii-entities")
    open_, done, draw = wanted.withColumn("draw", F.lit(0)), None, 0
    while True:
        drawn = stored(open_.withColumn("surrogate", surrogate(F.col("canon"), F.col("kind"), key, F.col("draw"))), "pii-drawn")
        occurring = wanted.select("kind", F.col("canon").alias("surrogate"))
        taken = occurring if done is None else occurring.unionByName(done.select("kind", "surrogate")).distinct()
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        good = stored(first.select("kind", "canon", "surrogate"), "pii-surrogates")
        done = good if done is None else done.unionByName(good)
        rest = drawn.join(good.select("kind", "canon"), ["kind", "canon"], "left_anti")
        draw += 1
        open_ = stored(rest.select("kind", "canon").withColumn("draw", F.lit(draw)), "pii-open")
        if open_.isEmpty():
            return done


def _with_bare_names(rows: DataFrame) -> DataFrame:
    """``rows`` with ``mentions`` in order and ``pattern``, which finds them in ``text``, from the mentions with titles, ``titled``.

    Names found after a title are looked for in the rest of the text, too: the full name, and the surname alone.
    """

    def of_kind(kind: str) -> Column:
        whole = F.filter("titled", lambda m: m.rlike(rf"^(?:{PATTERNS[kind]})$"))
        return F.transform(whole, lambda m: F.struct(F.lit(kind).alias("kind"), F.regexp_extract(m, r"^\S+ (.*)$", 1).alias("name")))

    titled = once(rows, "full", F.concat(*map(of_kind, NAMED)))
    surnames = F.transform("full", lambda n: F.struct(n["kind"].alias("kind"), F.substring_index(n["name"], " ", -1).alias("name")))
    # longer names first, as the first that fits counts
    longest = F.array_sort(
        F.array_distinct(F.concat("full", surnames)), lambda a, b: F.char_length(b["name"]) - F.char_length(a["name"])
    )
    named = once(titled, "names", longest).drop("full")
    quoted = F.array_join(F.transform("names", lambda n: F.concat(F.lit("\\Q"), n["name"], F.lit("\\E"))), "|")
    own = F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}\p{{N}}])(?:"), quoted, F.lit(r")(?![\p{L}\p{N}])"))
    patterned = once(named, "pattern", F.when(F.size("names") > 0, own).otherwise(F.lit(ANY)))
    again = once(patterned, "again", F.when(F.size("names") > 0, F.regexp_extract_all("text", F.col("pattern"), F.lit(0))))

    def mark(mention: Column) -> Column:
        bare = F.filter("names", lambda n: n["name"] == mention)
        return F.concat(F.coalesce(F.concat(F.lit(_BARE), F.get(bare, F.lit(0))["kind"], F.lit(" ")), F.lit("")), mention)

    return again.withColumn("mentions", F.coalesce(F.transform("again", mark), "titled")).drop("titled", "names", "again")


def replace_pii(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_surrogates``."""
    aside = Aside(docs, text=F.col(text))
    found = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    marked = aside.rows.withColumn("titled", found)
    any_found = F.coalesce(F.size("titled"), F.lit(0)) > 0
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    searched = stored(marked.where(any_found).withColumn("salt", spread), "pii-searched")
    with_entities = stored(_with_bare_names(searched), "pii-documents")
    lists = stored(with_entities.select(F.col("mentions").alias("list")).distinct(), "pii-lists")
    entities = stored(_entities(lists.select(F.explode("list").alias("mention")).distinct()), "pii-mentions")
    drawn = draw_surrogates(entities, key)
    before = F.when(F.startswith("before", F.lit(_BARE)), F.lit("")).otherwise(F.col("before"))
    new = F.concat(before, written(F.col("surrogate"), F.col("entity"), F.col("kind")), "after")
    by_mention = stored(entities.join(drawn, ["kind", "canon"]).select("mention", new.alias("new")), "pii-replacements")
    places = lists.select("list", F.posexplode("list").alias("k", "mention")).join(by_mention, "mention")
    replaced = stored(
        places.groupBy("list").agg(F.sort_array(F.collect_list(F.struct("k", "new"))).alias("pairs")).select(
            "list", F.col("pairs.new").alias("new")
        ),
        "pii-lists-replaced",
    )
    salted = replaced.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = with_entities.join(salted, (F.col("mentions") == F.col("list")) & (F.col("salt") == F.col("of_salt")))
    between = F.split("text", F.col("pattern"), -1)
    pieces = F.zip_with(between, F.concat("new", F.array(F.lit(""))), lambda a, b: F.concat(a, b))

    def finish(rows: DataFrame, made: Column, n: Column) -> DataFrame:
        return aside.back(rows, **{text: made, "n_surrogates": n}).select(*[c for c in docs.columns if c != "n_surrogates"], "n_surrogates")

    untouched = finish(marked.where(~any_found), F.col("text"), F.lit(0))
    return untouched.unionByName(finish(joined, F.array_join(pieces, ""), F.size("mentions")))
