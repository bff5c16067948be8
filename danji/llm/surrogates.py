"""Personal data: found entities get keyed stand-ins of the same kind, distinct and consistent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from danji.llm.common import cut

#: Given names that are taken for a person's where a surname follows, though no title stands before them.
WOMEN = (
    "Alice Amanda Amy Andrea Angela Anna Barbara Betty Carol Catherine Christine Claire Deborah Diana Elena Elizabeth Emily Emma "
    "Helen Isabel Jane Jennifer Jessica Julia Karen Kate Katherine Laura Linda Lisa Lucy Margaret Maria Marie Martha Mary "
    "Michelle Monica Nancy Nicole Olivia Patricia Rachel Rebecca Ruth Sandra Sarah Sophie Susan Teresa Victoria Wendy"
)
MEN = (
    "Adam Alan Albert Alexander Andrew Anthony Arthur Benjamin Brian Charles Christopher Daniel David Dennis Donald Edward Eric "
    "Francis Frank Fred Gary George Gerald Harold Harry Henry Jack Jacob James Jason Jeffrey John Jonathan Joseph Joshua Juan "
    "Kevin Larry Louis Mark Martin Matthew Michael Nicholas Oliver Patrick Paul Peter Philip Pierre Ralph Raymond Richard "
    "Robert Roger Ronald Samuel Scott Simon Stephen Steven Thomas Timothy Walter William"
)
HAN_SURNAMES = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗"
#: Kinds in the order they are tried at a place, with their Java patterns. Each begins with the signs it
#: can begin with, so that a pattern fails at once elsewhere, and no pattern reads a word again.
NAME = r"[\p{Lu}][\p{L}'’-]+"
KINDS = {
    # Read from the first sign of its run, or where the mention before ends; leading signs are not its own.
    "email": r"(?=[A-Za-z0-9._%+-])(?:\G|(?<![A-Za-z0-9._%+-]))[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}",
    "ip": r"(?=\d)(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ip6": r"(?=[0-9A-Fa-f]{1,4}:)(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
           r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "iban": r"(?=[A-Z]{2}\d)(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?=\d)(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?=[+(\d])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .-]?\d{2,5}){1,4}|(?<!\w)\(\d{3}\) ?\d{3}-\d{4}|(?<![\w-])\d{3}-\d{3}-\d{4}"
             r"|(?<![\w.-])0[1-9](?:[ .-]\d\d){4}|(?<![\w-])0\d{2,4}[/-]\d{5,8})(?!\w)",
    "card": r"(?=\d)(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)",
    # A person is recognised by the title beside the name, or by a given name, which also tell the gender.
    "woman": rf"(?=\p{{L}})(?:(?<!\p{{L}})(?:(?=[MFSГΚ])(?:Mrs\.?|MRS\.?|Ms\.?|MS\.?|Miss|MISS|Mme\.?|Madame|Frau|Señora|Sra\.|Г-жа|Госпожа|Κυρία|Κα) {NAME}(?: {NAME})?"
             rf"|(?=[A-W])(?:{WOMEN.replace(' ', '|')}) {NAME})|[{HAN_SURNAMES}]\p{{IsHan}}{{1,2}}(?:女士|小姐|太太))",
    "man": rf"(?=\p{{L}})(?:(?<!\p{{L}})(?:(?=[MHSГΚ])(?:Mr\.?|MR\.?|Monsieur|Herr|Señor|Sr\.|Г-н|Господин|Κύριος|Κος) {NAME}(?: {NAME})?"
           rf"|(?=[A-W])(?:{MEN.replace(' ', '|')}) {NAME})|[{HAN_SURNAMES}]\p{{IsHan}}{{1,2}}先生)",
    "person": rf"(?=[DPД])(?<!\p{{L}})(?:Dr\.?|DR\.?|Doctor|Prof\.?|Professor|Доктор) {NAME}(?: {NAME})?",
}
PERSONS = ("woman", "man", "person")


def _any_of(*kinds: str) -> str:
    return "(?:" + "|".join(f"(?:{KINDS[k]})" for k in kinds) + ")"


#: Any of them, where one can begin: not within a word, but for plus signs, Chinese names and what follows a mention.
ANY = rf"(?:(?<![A-Za-z])|\G|(?=[+{HAN_SURNAMES}]))(?=[A-Za-z0-9._%+(ГДΚ{HAN_SURNAMES}-])" + _any_of(*KINDS)
#: The same in parts, to tell cheaply whether a text has any: each is tried at fewer places, and IPv6 and
#: Chinese names only in texts with their signs.
NUMBERS = r"(?=[+(0-9]|[A-Z]{2}\d)(?:(?<!\w)|(?=\+))" + _any_of("ip", "iban", "ssn", "phone", "card")
IP6 = rf"(?=[0-9A-Fa-f])(?<!\w){KINDS['ip6']}"
NAMES = r"(?<!\p{L})(?=[A-WГДΚ])" + _any_of(*PERSONS)
HAN_TITLES = ("先生", "女士", "小姐", "太太")
HAN_NAMES = rf"[{HAN_SURNAMES}]\p{{IsHan}}{{1,2}}(?:{'|'.join(HAN_TITLES)})"
#: What is no name in a person's mention.
TITLE = rf"^(?:(?!(?:{WOMEN.replace(' ', '|')}|{MEN.replace(' ', '|')}) )[^\p{{IsHan}} ]\S* )?"
HAN_TITLE = rf"(?:{'|'.join(HAN_TITLES)})$"
#: From this turn on a stand-in that still collides is drawn from a larger space: numbers get so many more digits.
WIDER_TURN, MORE_DIGITS = 6, 8
#: Signs before an address, which stay as they are.
LEADING = r"^[._%+-]*"
#: Country codes, by their first digits.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Given names by gender and script; when they run out, and for surnames, names are made of syllables.
GIVEN = {
    ("woman", "latin"): ["Alma", "Berta", "Clara", "Dora", "Edna", "Flora", "Greta", "Hilda"],
    ("man", "latin"): ["Anton", "Bruno", "Carl", "Emil", "Felix", "Georg", "Hugo", "Kurt"],
    ("person", "latin"): ["Kim", "Robin", "Alex", "Toni", "Chris", "Sascha", "Dominique", "Noa"],
    ("woman", "cyrillic"): ["Алла", "Вера", "Дина", "Жанна", "Инна", "Лидия", "Майя", "Нина"],
    ("man", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван"],
    ("person", "cyrillic"): ["Саша", "Женя", "Валя", "Слава", "Шура", "Паша", "Лёва", "Тоня"],
    ("woman", "greek"): ["Άννα", "Δάφνη", "Ελένη", "Ζωή", "Κλειώ", "Λυδία", "Μαρία", "Νίκη"],
    ("man", "greek"): ["Άρης", "Γιάννης", "Ηλίας", "Κώστας", "Λουκάς", "Νίκος", "Πέτρος", "Σταύρος"],
    ("person", "greek"): ["Άρης", "Δάφνη", "Ηλίας", "Ζωή", "Λουκάς", "Νίκη", "Πέτρος", "Μαρία"],
}
#: How a given name of syllables ends.
ENDINGS = {"woman": {"latin": "na", "cyrillic": "на", "greek": "να"}, "man": {"latin": "rt", "cyrillic": "рт", "greek": "ος"},
           "person": {"latin": "n", "cyrillic": "н", "greek": "ν"}}
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "hu", "ka", "le", "mi", "no", "pu", "ra", "se", "ti", "vo", "wa", "ze"],
    "cyrillic": ["ба", "де", "фи", "го", "ху", "ка", "ле", "ми", "но", "пу", "ра", "се", "ти", "во", "ва", "зе"],
    "greek": ["βα", "δε", "φι", "γο", "θυ", "κα", "λε", "μι", "νο", "που", "ρα", "σε", "τι", "λο", "χα", "ζε"],
}
HAN_GIVEN = "安波成丹恩方光海江康兰明宁平青荣书天文雅"


def has_entity(text: Column) -> Column:
    """Whether ANY is found in the text; null texts have none."""
    numbers = text.rlike("[0-9]") & (text.rlike(NUMBERS) | (text.contains(":") & text.rlike(IP6)))
    titled = reduce(lambda a, b: a | b, [text.contains(t) for t in HAN_TITLES])
    found = (text.contains("@") & text.rlike(KINDS["email"])) | numbers | text.rlike(NAMES) | (titled & text.rlike(HAN_NAMES))
    return F.coalesce(found, F.lit(False))


def _kind(mention: Column) -> Column:
    return F.coalesce(*[F.when(mention.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in KINDS.items()], F.lit("other"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def canonical(kind: Column, mention: Column) -> Column:
    """What is the same entity in different spellings: case of an address, separators of a number."""
    return (
        F.when(kind == "email", F.lower(F.regexp_replace(mention, LEADING, "")))
        .when(kind.isin("phone", "card", "ssn"), F.concat(F.when(mention.startswith("+"), "+").otherwise(""), _digits(mention)))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "ip6", F.lower(mention))
        .otherwise(mention)
    )


def entities_of(kind: Column, mention: Column) -> Column:
    """The entities that a mention is made of, an array of (kind, value).

    A person is a surname, and before it, where there are two names, a given name with its gender: so
    "Mr. Smith" and "John Smith" get the same surname, in one text and in all. Capitals don't matter.
    """
    name = F.regexp_replace(F.regexp_replace(mention, TITLE, ""), HAN_TITLE, "")
    words = F.transform(F.split(name, " "), lambda w: F.initcap(w))

    def entity(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), value.alias("value"))

    surname = entity(F.lit("surname"), F.element_at(words, -1))
    both = F.array(entity(F.concat(F.lit("given_"), kind), words[0]), surname)
    person = F.when(F.size(words) > 1, both).otherwise(F.array(surname))
    return F.when(kind.isin(*PERSONS), person).otherwise(F.array(entity(kind, canonical(kind, mention))))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits (0 modulo 10 where it is valid)."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "(?<=.)(?=.)")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, b: a + b,
    )


def _iban_check(country: Column, account: Column) -> Column:
    """The two check digits by ISO 7064: 98 less the number's remainder, letters counting from 10."""
    signs = F.split(F.concat(account, country, F.lit("00")), "(?<=.)(?=.)")
    numbers = F.array_join(F.transform(signs, lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    rest = F.aggregate(F.split(numbers, "(?<=.)(?=.)"), F.lit(0), lambda a, d: (a * 10 + d.cast("int")) % 97)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _pick(words: list[str], hexadecimal: Column, at: int) -> Column:
    """One of 16 (or 8) words by a digit of the hash."""
    number = F.conv(F.substring(hexadecimal, at, 1), 16, 10).cast("int") % len(words)
    return F.element_at(F.array(*[F.lit(w) for w in words]), number + 1)


def surrogate(kind: Column, value: Column, key: str, turn: Column) -> Column:
    """The stand-in of a canonical value, keyed, of the same kind and format; `turn` varies it."""
    h = F.sha2(F.concat_ws("|", F.lit(key), kind, value, turn.cast("string")), 256)
    number = F.translate(h, "abcdef", "271828")
    digits = _digits(value)

    def part(at: int) -> Column:
        return F.conv(F.substring(h, at, 2), 16, 10)

    # An address keeps its shape and top domain below a reserved name; after some turns, in case the
    # shapes there are hold too few, it gets a long local part.
    letters = F.translate(h, "0123456789", "ghijkmnpqr")
    shape = F.array_join(F.transform(F.split(F.regexp_extract(value, r"^(.*@(?:.*\.)?)[^.@]+\.[^.]+$", 1), "(?<=.)(?=.)"), lambda c, i: (
        F.when(c.rlike("[a-z]"), F.substr(letters, i % 64 + 1, F.lit(1)))
        .when(c.rlike("[0-9]"), F.substr(number, i % 64 + 1, F.lit(1))).otherwise(c))), "")
    email = F.concat(
        F.when(turn < 3, shape).otherwise(F.concat(F.substring(letters, 1, 24), F.lit("@"))),
        F.lit("example."), F.regexp_extract(value, r"[^.]+$", 0),
    )
    # The first digits of a private range stay, so that an address stays private or public; the small
    # range gives way to the large one after some turns.
    octet = [part(at) for at in (1, 3, 5, 7)]
    public = (F.conv(F.substring(h, 9, 2), 16, 10).cast("int") % 80 + 11).cast("string")
    ip = (
        F.when(value.rlike(r"^(10|127)\."), F.concat_ws(".", F.regexp_extract(value, r"^\d+", 0), *octet[:3]))
        .when(value.rlike(r"^192\.168\.") & (turn < 4), F.concat_ws(".", F.lit("192.168"), *octet[:2]))
        .when(value.rlike(r"^192\.168\."), F.concat_ws(".", F.lit("10"), *octet[:3]))
        .otherwise(F.concat_ws(".", public, *octet[1:]))
    )
    ip = F.when(turn < WIDER_TURN, ip).otherwise(F.concat_ws(":", F.lit("fd00"), *[F.substring(h, at, 4) for at in range(9, 37, 4)]))
    # A private or local network stays one; groups keep their number.
    groups = F.split(value, ":")
    ip6 = F.array_join(F.transform(groups, lambda g, i: F.when(g == "", g).when(
        (i == 0) & value.rlike("^f[cde]"), g).otherwise(F.substr(F.concat(F.lit("a"), h), i * 4 % 56 + 1, F.lit(4)))), ":")
    ip6 = F.when(turn < WIDER_TURN, ip6).otherwise(F.concat_ws(":", F.lit("fd00"), *[F.substring(h, at, 4) for at in range(9, 37, 4)]))
    # Country codes, and the first digits of national numbers and cards, stay, and a valid check digit
    # stays valid. Short telephone numbers have few others of their length, so numbers get longer after
    # some turns.
    more = F.when(turn < WIDER_TURN, 0).otherwise(MORE_DIGITS)
    head = F.when(value.startswith("+"), F.regexp_extract(value, COUNTRY, 0)).when(
        value.startswith("0"), F.left(value, F.lit(2))).otherwise(F.left(value, F.lit(1)))
    phone = F.left(F.concat(head, F.substring(number, 1, 40)), F.length(value) + more)
    body = F.left(F.concat(F.substring(digits, 1, 1), number), F.length(digits) - 1 + more)
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.concat(body, F.when(_luhn(digits) % 10 == 0, check).otherwise(F.substring(number, 40, 1)))
    ssn = F.concat(F.lit("9"), F.left(number, F.length(value) - 1 + more))
    # Letters stay letters and digits digits; the check digits are those of the new number.
    capitals = F.translate(h, "0123456789abcdef", "GHJKLMNPQRSTUVWX")
    account = F.array_join(F.transform(F.split(F.substring(value, 5, 40), "(?<=.)(?=.)"), lambda c, i: F.when(
        c.rlike("[A-Z]"), F.substr(capitals, i + 1, F.lit(1))).otherwise(F.substr(number, i + 1, F.lit(1)))), "")
    account = F.concat(account, F.when(turn < WIDER_TURN, "").otherwise(F.substring(number, 50, MORE_DIGITS)))
    iban = F.concat(F.left(value, F.lit(2)), _iban_check(F.left(value, F.lit(2)), account), account)
    script = (
        F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek")
        .when(value.rlike(r"\p{IsHan}"), "han").otherwise("latin")
    )

    def syllables(alphabet: str, first: int, last: int) -> Column:
        return F.concat(*[_pick(SYLLABLES[alphabet], h, at) for at in range(first, last)])

    def made(alphabet: str) -> Column:
        return F.concat(syllables(alphabet, 2, 5), F.when(turn < 3, "").otherwise(syllables(alphabet, 5, 11)))

    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "phone", phone)
    out = out.when(kind == "card", card).when(kind == "iban", iban).when(kind == "ssn", ssn)
    han_given = F.concat(*[_pick(list(HAN_GIVEN[:16]), h, at) for at in (2, 3)])
    han = F.concat(_pick(list(HAN_SURNAMES[:16]), h, 1), F.when(turn < 3, F.substr(han_given, F.lit(1), F.length(value) - 1)).otherwise(
        F.concat(han_given, _pick(list(HAN_GIVEN[4:]), h, 4), _pick(list(HAN_GIVEN[:16]), h, 5))))
    out = out.when(script == "han", han)
    for alphabet in SYLLABLES:
        out = out.when((kind == "surname") & (script == alphabet), F.initcap(made(alphabet)))
        for gender in PERSONS:
            listed = _pick(GIVEN[gender, alphabet], h, 1)
            longer = F.initcap(F.concat(made(alphabet), F.lit(ENDINGS[gender][alphabet])))
            out = out.when((kind == f"given_{gender}") & (script == alphabet), F.when(turn < 2, listed).otherwise(longer))
    return out.otherwise(F.left(h, F.length(value)))


def in_format(kind: Column, mention: Column, stand_in: Column) -> Column:
    """The stand-in in the mention's own spelling: separators, title, capitals."""
    signs = F.split(mention, "(?<=.)(?=.)")
    plain = F.replace(stand_in, F.lit("+"), F.lit(""))
    numbered = F.array_join(F.transform(signs, lambda c, i: F.when(
        c.rlike("[0-9A-Z]"), F.substr(plain, F.length(F.regexp_replace(F.array_join(F.slice(signs, F.lit(1), i + 1), ""), "[^0-9A-Z]", "")), F.lit(1))
    ).otherwise(c)), "")
    # Digits of a stand-in that is longer follow the last one.
    numbered = F.concat(numbered, F.substr(plain, F.length(F.regexp_replace(mention, "[^0-9A-Z]", "")) + 1))
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), numbered)
        .when(kind == "email", F.concat(
            F.regexp_extract(mention, LEADING, 0), F.when(mention == F.upper(mention), F.upper(stand_in)).otherwise(stand_in)))
        .when(kind == "ip6", F.when(mention == F.upper(mention), F.upper(stand_in)).otherwise(stand_in))
        .otherwise(stand_in)
    )


def named(mention: Column, names: Column) -> Column:
    """A person's stand-in names behind, or before, the mention's own title; in capitals if it is."""
    name = F.regexp_replace(F.regexp_replace(mention, TITLE, ""), HAN_TITLE, "")
    joined = F.array_join(names, " ")
    cased = F.when((name == F.upper(name)) & (name != F.lower(name)), F.upper(joined)).otherwise(joined)
    return F.concat(F.regexp_extract(mention, TITLE, 0), cased, F.regexp_extract(mention, HAN_TITLE, 0))


def stand_ins(entities: DataFrame, key: str, most_turns: int = 24) -> DataFrame:
    """A stand-in for each (kind, value), no two alike within a kind and none that is a real value.

    Of those that collide, the smallest value keeps its stand-in and the others draw again. Turns
    see only what is still open, by equi-joins; every kind's space is widened after some turns, to
    10^8 times and more, so that the few turns after that are enough; a table for which they aren't
    is an error.
    """
    entities = entities.select("kind", "value").distinct()
    open_, done = entities, None
    for turn in range(most_turns):
        drawn = open_.withColumn("stand_in", surrogate(F.col("kind"), F.col("value"), key, F.lit(turn)))
        real = entities.select("kind", F.col("value").alias("stand_in"))
        free = drawn.join(real, ["kind", "stand_in"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "stand_in"), ["kind", "stand_in"], "left_anti")
        won = cut(free.groupBy("kind", "stand_in").agg(F.min("value").alias("value")).select("kind", "value", "stand_in"))
        done = won if done is None else done.unionByName(won)
        open_ = cut(drawn.select("kind", "value").join(won, ["kind", "value"], "left_anti"))
        if open_.isEmpty():
            return done
    raise ValueError(f"stand-ins still collide after {most_turns} turns")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text with its entities replaced, n_entities.

    Entities: e-mail, IPv4 and IPv6 addresses, IBANs, social security, telephone (international, and
    some national forms) and card numbers, and persons: names with a title (in several languages and
    in capitals; before the name, or behind a Chinese one), and a listed given name with a surname. The
    same entity gets the same stand-in in every document, in the spelling of each mention; different
    ones get different ones, and none gets a value that occurs itself. Given names and surnames are
    entities of their own, so a person is the same with and without the given name. Gender, script
    (Latin, Cyrillic, Greek, Chinese), country codes, the first digit of a card, check digits, letters and
    digits of an IBAN, private ranges, separators, title and capitals are kept. Names alone, without a
    title or a listed given name, are not found.

    Texts without an entity pass through without a shuffle; the others are kept in the shared folder, so a
    text is searched twice. Distinct values are drawn for once; a
    mention is joined to its stand-in, a value that a third of all texts hold being one row there
    (AQE splits the other side). Mentions are gathered by the digest of their text, so copies are
    gathered once; a text's mentions are bounded by its length. Null texts stay null, empty texts
    empty; ids pass through, repeated or null; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    has = has_entity(F.col("text"))
    clean = rows.where(~has).select("doc_id", "text", F.lit(0).cast("bigint").alias("n_entities"))
    touched = cut(rows.where(has).withColumn("digest", F.sha2("text", 256)))
    mentions = cut(
        touched.groupBy("digest").agg(F.first("text").alias("text"))
        .select("digest", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("at", "mention"))
        .withColumn("what", _kind(F.col("mention")))
        .select("digest", "at", "mention", "what", F.posexplode(entities_of(F.col("what"), F.col("mention"))).alias("part", "entity"))
        .select("digest", "at", "mention", "what", "part", "entity.kind", "entity.value")
    )
    drawn = stand_ins(mentions, key)
    parts = mentions.join(drawn, ["kind", "value"]).groupBy("digest", "at", "mention", "what").agg(
        F.array_sort(F.collect_list(F.struct("part", "stand_in"))).alias("parts")
    )
    names = F.col("parts.stand_in")
    new = F.when(F.col("what").isin(*PERSONS), named(F.col("mention"), names)).otherwise(in_format(F.col("what"), F.col("mention"), names[0]))
    ready = parts.select("digest", "at", new.alias("new"))
    by_text = ready.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("news"))
    # What lies between the mentions, and the stand-ins in their places.
    pieces = F.split("text", ANY, -1)
    joined = F.array_join(F.zip_with(pieces, F.col("news.new"), lambda p, n: F.concat(F.coalesce(p, F.lit("")), F.coalesce(n, F.lit("")))), "")
    replaced = touched.join(by_text, "digest").select("doc_id", joined.alias("text"), F.size("news").cast("bigint").alias("n_entities"))
    return clean.unionByName(replaced)
