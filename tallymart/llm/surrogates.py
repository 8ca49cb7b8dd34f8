"""PII surrogates: detected entities get keyed replacements of the same type and format.

An entity has a kind and a canonical form (digits only, lower case), so its spellings get
one surrogate, dressed as each spelling is: separators, case, country code, first digit of
a card and its check digit, valid octets.  Names after a title are replaced by names of the
title's gender in the script of the name.  A surrogate is a function of key, kind,
canonical form and attempt.  All distinct entities are checked together: where surrogates
of two entities meet, or one is itself an entity of the data, later attempts are taken for
all but one, until none meet.  Later attempts draw from wider sets, so that they come to an
end however many entities there are: a name gets one more family name with each attempt;
from ``WIDER`` on octets may have any length, and mail addresses and phone numbers of few
digits get one more character with each attempt.  The other kinds are as wide as their
format.  Rows are joined only to the few entities with such attempts.

Only DataFrame and SQL functions run on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import stage

#: Attempt from which short formats are left, and the most family names and added characters.
WIDER, FAMILIES, ADDED = 2, 28, {"email": 48, "phone": 8}
#: Attempts after which the data is taken to hold more entities than their format has places for.
ATTEMPTS = 100
# Titles by gender, and names to choose from by script and gender.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Г-жа", "Госпожа", "Κυρία"],
    "m": ["Mr", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Г-н", "Господин", "Κύριος"],
}
GIVEN = {
    ("Latin", "f"): ["Anna", "Clara", "Diana", "Elena", "Greta", "Helen", "Irene", "Julia", "Laura", "Maria", "Nadia", "Paula", "Rosa", "Sara", "Teresa", "Vera"],
    ("Latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Oscar", "Paul", "Simon", "Victor"],
    ("Cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("Cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Иван", "Максим", "Олег", "Павел"],
    ("Greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Κλειώ", "Μαρία", "Νίκη", "Σοφία", "Χαρά"],
    ("Greek", "m"): ["Άρης", "Γιώργος", "Ηλίας", "Κώστας", "Λουκάς", "Νίκος", "Πέτρος", "Σπύρος"],
}
FAMILY = {
    ("Latin", "f"): ["Adler", "Becker", "Costa", "Duval", "Engel", "Fischer", "Garner", "Holm", "Keller", "Lang", "Moreau", "Navarro", "Olsen", "Palmer", "Roth", "Winter"],
    ("Cyrillic", "f"): ["Белова", "Волкова", "Громова", "Зуева", "Котова", "Лунина", "Орлова", "Титова"],
    ("Cyrillic", "m"): ["Белов", "Волков", "Громов", "Зуев", "Котов", "Лунин", "Орлов", "Титов"],
    ("Greek", "f"): ["Βλάχου", "Γεωργίου", "Ιωάννου", "Λάππα", "Νικολάου", "Παππά", "Ρήγα", "Χρήστου"],
    ("Greek", "m"): ["Βλάχος", "Γεωργίου", "Ιωάννου", "Λάππας", "Νικολάου", "Παππάς", "Ρήγας", "Χρήστου"],
}
FAMILY["Latin", "m"] = FAMILY["Latin", "f"]

_title = "|".join(t for titles in TITLES.values() for t in titles)
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\d|\.\d)"
CARD = r"(?<!\d)\d{4}(?:[ -]?\d{4}){3}(?!\d)|(?<!\d)\d{13,19}(?!\d)"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
PHONE = (
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<!\d)\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)"
)
NUMBER = r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"
NAME = rf"(?<!\w)(?:{_title})\.? \p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?"
ENTITY = "|".join((EMAIL, IP, CARD, IBAN, PHONE, NUMBER, NAME))
KINDS = ("email", "ip", "card", "iban", "phone", "number", "name")


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _whole(pattern: str) -> str:
    return quoted(f"^(?:{pattern})$")


def _kind(e: str) -> str:
    return (
        f"case when {e} like '%@%' then 'email' when {e} rlike {_whole(NAME)} then 'name' "
        f"when {e} rlike {_whole(IP)} then 'ip' when {e} rlike {_whole(CARD)} then 'card' "
        f"when {e} rlike {_whole(NUMBER)} then 'number' when {e} rlike {_whole(IBAN)} then 'iban' "
        "else 'phone' end"
    )


def _canonical(k: str, e: str) -> str:
    """Gender stands in the canonical form of a name, so that it is part of who is meant."""
    women = quoted("^(?:" + "|".join(TITLES["f"]) + ")(?!\\p{L})")
    bare = f"regexp_replace({e}, {quoted(f'^(?:{_title})[.]? ')}, '')"
    return (
        f"case {k} when 'email' then lower({e}) when 'ip' then {e} "
        f"when 'name' then concat(if({e} rlike {women}, 'f:', 'm:'), lower({bare})) "
        f"when 'iban' then replace({e}, ' ', '') else regexp_replace({e}, '[^0-9]', '') end"
    )


def typed(array: str) -> str:
    """SQL: kind, canonical form and spelling of each string of an array."""
    kinds = f"transform({array}, e -> named_struct('e', e, 'k', {_kind('e')}))"
    canonical = _canonical("x.k", "x.e")
    return f"transform({kinds}, x -> named_struct('e', x.e, 'k', x.k, 'c', {canonical}))"


def _luhn(digits: str) -> str:
    """SQL: Luhn sum of a string of digits."""
    digit = f"int(substr({digits}, length({digits}) - i, 1))"
    double = f"if(2 * {digit} > 9, 2 * {digit} - 9, 2 * {digit})"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (s, i) -> s + if(i % 2 = 1, {double}, {digit}))"


def _number(h: str, at: str) -> str:
    """SQL: a number below 65536 from place ``at`` (0 to 29) of a hash."""
    return f"int(conv(substr({h}, 1 + 4 * ({at}), 4), 16, 10))"


def _octet(h: str, of: str, at: int) -> str:
    part, n = f"split_part({of}, '.', {at + 1})", _number(h, str(at))
    as_long = f"case length({part}) when 3 then 100 + {n} % 156 when 2 then 10 + {n} % 90 else {n} % 10 end"
    return f"if(a >= {WIDER}, {n} % 256, {as_long})"


def _chosen(lists: dict, script: str, gender: str, number: str) -> str:
    whens = " ".join(
        f"when {script} = '{s}' and {gender} = '{g}' then element_at(array({', '.join(map(quoted, names))}), {number} % {len(names)} + 1)"
        for (s, g), names in lists.items()
    )
    return f"case {whens} end"


def surrogate(kind: str, canonical: str, attempt: str, key: str) -> str:
    """SQL: surrogate of a canonical form, in canonical form (a name in title case)."""
    seed = f"sha2(concat_ws('|', {quoted(key)}, {kind}, {canonical}, {attempt}), 512)"
    digit = "substr(translate(h, 'abcdef', '274905'), (i - 1) % 128 + 1, 1)"
    letter = "substr(translate(h, '0123456789abcdef', 'bcdfghklmnprstvz'), (i - 1) % 128 + 1, 1)"

    def by_character(stays: str) -> str:
        return (
            f"array_join(transform(sequence(1, length(c)), i -> case when {stays} then substr(c, i, 1) "
            f"when substr(c, i, 1) rlike '[0-9]' then {digit} "
            f"when substr(c, i, 1) rlike '[a-z]' then {letter} "
            f"when substr(c, i, 1) rlike '[A-Z]' then upper({letter}) else substr(c, i, 1) end), '')"
        )

    top = "i > length(c) - length(substring_index(c, '.', -1))"
    digits = by_character("(k = 'card' and i = 1) or (k = 'phone' and i <= length(c) - 10)")
    checked = f"concat(substr(d, 1, length(d) - 1), string((10 - {_luhn("concat(substr(d, 1, length(d) - 1), '0')")} % 10) % 10))"
    card = f"element_at(transform(array({digits}), d -> if({_luhn('c')} % 10 = 0, {checked}, d)), 1)"
    # what later attempts add: letters before an address, digits after a short number
    more = f"sequence(1, least(a - {WIDER} + 1, {{}}))"
    letters, figures = (
        f"if(a >= {WIDER}, array_join(transform({more.format(ADDED[k])}, n -> substr(translate(h, {of}), 129 - n, 1)), ''), '')"
        for k, of in (("email", "'0123456789abcdef', 'bcdfghklmnprstvz'"), ("phone", "'abcdef', '274905'"))
    )
    phone = f"concat({digits}, if(length(c) < 10, {figures}, ''))"
    ip = "concat_ws('.', " + ", ".join(_octet("h", "c", n) for n in range(4)) + ")"
    script = "case when c rlike '\\\\p{IsCyrillic}' then 'Cyrillic' when c rlike '\\\\p{IsGreek}' then 'Greek' else 'Latin' end"
    gender = "substr(c, 1, 1)"
    given = _chosen(GIVEN, script, gender, _number("h", "0"))
    # one word for one word; further attempts join ever more family names
    family = _chosen(FAMILY, script, gender, _number("h", "n"))
    family = f"array_join(transform(sequence(1, least(a + 1, {FAMILIES})), n -> {family}), '-')"
    name = f"concat({gender}, ':', if(c like '% %', concat({given}, ' ', {family}), {family}))"
    body = (
        f"case k when 'email' then concat({letters}, {by_character(top)}) when 'ip' then {ip} when 'name' then {name} "
        f"when 'card' then {card} when 'iban' then {by_character('i <= 4')} when 'phone' then {phone} else {digits} end"
    )
    # the names k, c, a and h are bound once
    bound = f"array(named_struct('k', {kind}, 'c', {canonical}, 'a', {attempt}, 'h', {seed}))"
    for short in ("k", "c", "a", "h"):
        body = _bind(body, short)
    return f"element_at(transform({bound}, b -> {body}), 1)"


def _bind(sql: str, short: str) -> str:
    import re

    # outside quotes only
    parts = re.split(r"('(?:[^'\\]|\\.)*')", sql)
    return "".join(p if n % 2 else re.sub(rf"(?<![\w.]){short}(?![\w(])", f"b.{short}", p) for n, p in enumerate(parts))


def dressed(kind: str, spelling: str, new: str) -> str:
    """SQL: a canonical surrogate in the format of a spelling."""
    place = f"length(regexp_replace(substr({spelling}, 1, i), '[^0-9]', ''))"
    digits = (
        f"array_join(transform(sequence(1, length({spelling})), i -> if(substr({spelling}, i, 1) rlike '[0-9]', "
        f"substr({new}, {place}, 1), substr({spelling}, i, 1))), '')"
    )
    added = f"(length({new}) - length({spelling}))"
    case = (
        f"concat(substr({new}, 1, {added}), array_join(transform(sequence(1, length({spelling})), i -> "
        f"if(substr({spelling}, i, 1) rlike '[A-Z]', upper(substr({new}, {added} + i, 1)), substr({new}, {added} + i, 1))), ''))"
    )
    further = f"substr({new}, 1 + length(regexp_replace({spelling}, '[^0-9]', '')))"
    before = f"length(replace(substr({spelling}, 1, i), ' ', ''))"
    spaced = (
        f"array_join(transform(sequence(1, length({spelling})), i -> if(substr({spelling}, i, 1) = ' ', ' ', "
        f"substr({new}, {before}, 1))), '')"
    )
    title = f"regexp_extract({spelling}, {quoted(f'^(?:{_title})[.]? ')}, 0)"
    return (
        f"case {kind} when 'email' then {case} when 'ip' then {new} when 'iban' then {spaced} "
        f"when 'name' then concat({title}, substr({new}, 3)) when 'phone' then concat({digits}, {further}) else {digits} end"
    )


def settled(entities: DataFrame, key: str) -> DataFrame:
    """k, c, attempt of all distinct entities (k, c): no two of a kind share a surrogate, and
    none is an entity of the data.  Fails only where a format has no place left for that
    (more than half of all numbers of nine digits, say)."""
    table = stage(entities.distinct().withColumn("attempt", F.lit(0)), "entities")
    for _ in range(ATTEMPTS):
        named = table.withColumn("s", F.expr(f"lower({surrogate('k', 'c', 'attempt', key)})"))
        named = stage(named, "surrogates")
        shared = named.groupBy("k", "s").agg(F.min("c").alias("least"), F.count("*").alias("n"))
        shared = stage(shared.where("n > 1").drop("n"), "shared")
        real = named.select("k", F.col("c").alias("s")).withColumn("real", F.lit(True))
        marked = named.join(shared, ["k", "s"], "left").join(real, ["k", "s"], "left")
        again = F.expr("coalesce(c != least, false) or coalesce(real, false)")
        marked = stage(marked.select("k", "c", "attempt", again.alias("again")), "marked")
        if marked.where("again").isEmpty():
            return table
        table = stage(
            marked.select("k", "c", (F.col("attempt") + F.col("again").cast("int")).alias("attempt")), "entities"
        )
    kinds = [r.k for r in marked.where("again").select("k").distinct().collect()]
    raise ValueError(f"no distinct surrogates are left in the format of these kinds: {sorted(kinds)}")



def surrogates(spark: SparkSession, docs: DataFrame, key: str) -> DataFrame:
    """Per row of ``docs``: doc_id, text with surrogates, and n_<kind> for each kind.

    A null text stays null and has no entities; other columns are not read.  Repeated rows
    and copies get the same surrogates, in every run with the same key and data.
    """
    found = F.expr(f"regexp_extract_all(coalesce(text, ''), {quoted(ENTITY)}, 0)")
    entities = (
        docs.select(F.explode(F.array_distinct(found)).alias("e"))
        .groupBy("e")
        .agg(F.lit(1).alias("one"))
        .select(F.expr(f"{typed('array(e)')}[0]").alias("x"))
        .select("x.k", "x.c")
    )
    table = settled(entities, key)
    later = stage(table.where("attempt > 0"), "later_attempts")
    rows = docs.select("doc_id", "text").withColumn("found", found)
    rows = rows.withColumn("typed", F.expr(typed("found")))
    attempt = "0"
    if not later.isEmpty():
        # the attempts of entities met in a text, for the texts that have such entities
        rows = rows.withColumn("names", F.expr("transform(typed, x -> concat(x.k, '|', x.c))"))
        name = F.concat("k", F.lit("|"), "c").alias("name")
        of_text = (
            docs.select("doc_id", F.explode(F.array_distinct(found)).alias("e"), F.xxhash64("text").alias("mark"))
            .select("doc_id", "mark", F.expr(f"{typed('array(e)')}[0]").alias("x"))
            .select("doc_id", "mark", F.concat("x.k", F.lit("|"), "x.c").alias("name"))
            .join(later.select(name, "attempt"), "name")
            .distinct()
            .groupBy("doc_id", "mark")
            .agg(F.map_from_entries(F.collect_list(F.struct("name", "attempt"))).alias("attempts"))
        )
        of_text = stage(of_text, "attempts_of_texts").alias("a")
        rows = rows.withColumn("mark", F.xxhash64("text")).alias("d")
        rows = rows.join(of_text, F.expr("d.doc_id <=> a.doc_id and d.mark = a.mark"), "left").select(
            "d.*", "a.attempts"
        )
        attempt = "coalesce(attempts[concat(x.k, '|', x.c)], 0)"
    new = f"transform(typed, x -> named_struct('k', x.k, 'e', x.e, 's', {surrogate('x.k', 'x.c', attempt, key)}))"
    rows = rows.withColumn("new", F.expr(new))
    rows = rows.withColumn("new", F.expr(f"transform(new, x -> {dressed('x.k', 'x.e', 'x.s')})"))
    pieces = f"split(text, {quoted(ENTITY)}, -1)"
    text = f"if(size(found) > 0, array_join(flatten(zip_with({pieces}, new, (p, n) -> array(p, coalesce(n, '')))), ''), text)"
    counts = [F.expr(f"size(filter(typed, x -> x.k = '{k}'))").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", F.expr(text).alias("text"), *counts)
