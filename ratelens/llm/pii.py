r"""Surrogates for personal data: keyed, of the same kind and format, distinct and coherent.

Entities are found by pattern: mail addresses, telephone numbers, IPv4 addresses, card or account
numbers of 13 to 19 digits, and names after a title. An entity is its kind and its normal form (mail
addresses and names without case, numbers by their digits; of names also the title's gender), so all its
mentions in all texts get the same surrogate. A surrogate is drawn from a keyed hash of the entity:
letters become letters, vowels vowels, digits digits; a name becomes a made-up name with as many words in
the title's gender and the same script. The last two labels of a mail's domain stay.

Where a text has a name after a title, its further mentions in that text without a title, whole or by its
last word, are replaced by the same surrogate or its last word.

Draws are checked over the whole corpus. A draw is refused when it is the normal form of an entity
that occurs, or when another entity has it already; of several that draw the same in one round the
smallest keeps it. Refused entities draw again with the next round's hash until none is left. After
``WIDER_FROM`` rounds a format counts as full, and each further round draws one character more.

Built-in functions only. Texts without an entity are never taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm.tables import kept, texts

# Titles that tell a gender, in the languages of the texts.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Госпожа"),
          "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")}
# Titles that tell none, and words inside names that are not capitalised.
TITLES_OF_ALL = ("Dr", "Prof", "Professor", "Doctor", "Mx", "Доктор")
PARTICLES = ("de", "la", "del", "da", "di", "du", "le", "van", "von", "der", "den", "y")
_TITLE = "|".join(sorted({*TITLES_OF_ALL, *(t for group in TITLES.values() for t in group)},
                         key=lambda t: (-len(t), t)))
_TITLED = rf"\A(?:{_TITLE})\.?\x20"
# A capitalised word, with an apostrophe only before a capital, or an initial.
_WORD = r"\p{Lu}(?:\.(?=\x20\p{Lu})|[\p{L}\p{M}]*(?:['’]\p{Lu}[\p{L}\p{M}]*)*)"
_SMALL = rf"(?:(?:{'|'.join(PARTICLES)})\x20){{0,3}}"
NAME = rf"{_SMALL}{_WORD}(?:[\x20-]{_SMALL}{_WORD})*"
_LAST = r"[^\x20-]+\z"

# Kind and pattern; where two start at one place the first that is listed wins.
PATTERNS: dict[str, str] = {
    "mail": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<![\w+])\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,3}(?![0-9])"
             r"|(?<![\w+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w-]|\.[0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?!\.?[0-9])",
    "number": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}(?:[\x20-][0-9]{3})?"
              r"|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.?\x20{NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MOST_ROUNDS = 64
WIDER_FROM = 16                 # a round; formats with entities left by then are full

VOWELS, CONSONANTS, DIGITS = "aeiou", "bcdfghjklmnpqrstvwxyz", "0123456789"
# Made-up names: syllables, and endings by gender; in Cyrillic letter by letter.
SYLLABLES = ("ba", "bel", "da", "dor", "fa", "fen", "ga", "gil", "ka", "kor", "la", "len", "ma", "mir",
             "na", "nor", "ra", "rin", "sa", "sel", "ta", "tol", "va", "vin")
ENDINGS = {"f": ("na", "ra", "la", "sa"), "m": ("n", "r", "k", "s")}
LATIN, CYRILLIC = "abcdefghijklmnoprstuvz", "абцдефгхижклмнопрстувз"


def kind_of(mention: Column) -> Column:
    """The kind whose pattern is the whole mention."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(rf"\A(?:{pattern})\z"), F.lit(kind)).otherwise(out)
    return out


def _bare(mention: Column) -> Column:
    """A name without its title."""
    return F.regexp_replace(mention, _TITLED, "")


def normal_form(kind: Column, mention: Column) -> Column:
    """What all mentions of an entity have in common. A name's title is not part of it."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    name = F.lower(_bare(mention))
    return F.when(kind == "mail", F.lower(mention)).when(kind == "ip", mention) \
        .when(kind == "name", name).otherwise(digits)


def _gender(mention: Column) -> Column:
    """``f`` or ``m`` by the title of a name, empty for other titles and mentions."""
    of = [rf"\A(?:{'|'.join(TITLES[g])})\.?\x20{NAME}\z" for g in "fm"]
    return F.when(mention.rlike(of[0]), F.lit("f")).when(mention.rlike(of[1]), F.lit("m")).otherwise(F.lit(""))


def _stream(key: str, *of: Column) -> Column:
    """128 hexadecimal digits that only the key's owner can compute."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *of), 512)


def _drawn(stream: Column, place: Column, most: int) -> Column:
    """A number below ``most`` from three hexadecimal digits of the stream, round and round."""
    at = F.pmod(place * 2, F.lit(126)) + 1
    three = F.substring(stream, at, F.lit(3))
    return F.pmod(F.conv(three, 16, 10).cast("int"), F.lit(most))


def _letter(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at + 1, F.lit(1))


def _like(form: Column, stream: Column, keep: Column) -> Column:
    """``form`` with each character redrawn in its class; the first ``keep`` stay as they are."""
    chars = F.split(form, "")

    def redrawn(c: Column, i: Column) -> Column:
        return F.when(i < keep, c) \
            .when(F.lit(DIGITS).contains(c), _letter(DIGITS, _drawn(stream, i, 10))) \
            .when(F.lit(VOWELS).contains(c), _letter(VOWELS, _drawn(stream, i, 5))) \
            .when(F.lit(CONSONANTS).contains(c), _letter(CONSONANTS, _drawn(stream, i, 21))) \
            .otherwise(c)
    return F.array_join(F.transform(chars, redrawn), "")


def _one_of(values: tuple[str, ...], stream: Column, place: int) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _drawn(stream, F.lit(place), len(values)) + 1)


def _made_up(gender: Column, stream: Column, syllables: int) -> Column:
    ends = {g: _one_of(e, stream, 40) for g, e in (*ENDINGS.items(), ("", ENDINGS["f"] + ENDINGS["m"]))}
    end = F.when(gender == "f", ends["f"]).when(gender == "m", ends["m"]).otherwise(ends[""])
    return F.concat(*[_one_of(SYLLABLES, stream, i) for i in range(syllables)], end)


def _draw(kind: Column, form: Column, gender: Column, stream: Column, round_: int) -> Column:
    """The normal form of an entity's surrogate; later rounds have more room for names.

    From ``WIDER_FROM`` on addresses and numbers get one character more a round, an IPv4 address a port.
    """
    more = max(0, round_ - WIDER_FROM + 1)
    letters = [_letter(CONSONANTS, _drawn(stream, F.lit(50 + i), 21)) for i in range(more)]
    figures = [_letter(DIGITS, _drawn(stream, F.lit(50 + i), 10)) for i in range(more)]
    local = F.substring_index(form, "@", 1)
    domain = F.substring_index(form, "@", -1)
    host = F.regexp_replace(domain, r"\.?[^.]*\.[^.]*\z", "")     # all but the last two labels
    last = F.substring(domain, F.length(host) + 1, F.length(domain))
    first = F.when(host == "", F.lit("")).otherwise(_like(host, F.reverse(stream), F.lit(0)))
    mail = F.concat(_like(local, stream, F.lit(0)), *letters, F.lit("@"), first, last)
    octets = F.array(*[_drawn(stream, F.lit(i), 254) + 1 for i in range(4)])
    ip = F.array_join(F.transform(octets, lambda o: o.cast("string")), ".")
    if more:
        ip = F.concat(ip, F.lit(":"), (_drawn(stream, F.lit(8), 4000) + 1024).cast("string"))
    # The first digit of a country code stays; so does the length.
    digits = F.concat(_like(form, stream, F.when(kind == "phone", 1).otherwise(0)), *figures)
    parts = F.regexp_extract_all(form, F.lit(r"([\x20-]|[^\x20-]+)"), 1)
    name = F.array_join(F.transform(parts, lambda w, i: F.when(w.isin(" ", "-", *PARTICLES), w).otherwise(
        _made_up(gender, F.sha2(F.concat(stream, i.cast("string")), 512), 2 + round_ // 4))), "")
    name = F.when(form.rlike(r"\p{IsCyrillic}"), F.translate(name, LATIN, CYRILLIC)).otherwise(name)
    return F.when(kind == "mail", mail).when(kind == "ip", ip).when(kind == "name", name) \
        .otherwise(digits)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``form``, ``gender``, ``surrogate`` (a normal form) for distinct ``kind``, ``form``, ``gender``.

    No two entities of a kind share a surrogate and none is an entity of the corpus. Raises
    ``RuntimeError`` when after ``MOST_ROUNDS`` rounds some have none; with rounds above ``WIDER_FROM``
    formats grow until there is room.
    """
    entity = ["kind", "form", "gender"]
    waiting, given = entities, None
    for round_ in range(MOST_ROUNDS):
        stream = _stream(key, F.lit(str(round_)), *[F.col(c) for c in entity])
        drawn = waiting.withColumn("surrogate", _draw(*[F.col(c) for c in entity], stream, round_))
        used = entities.select("kind", F.col("form").alias("surrogate"))
        if given is not None:
            used = used.unionByName(given.select("kind", "surrogate"))
        free = drawn.join(used, ["kind", "surrogate"], "left_anti")
        won = kept(free.groupBy("kind", "surrogate").agg(F.min(F.struct("form", "gender")).alias("one"))
                   .select("kind", "one.*", "surrogate"), "surrogates")
        given = won if given is None else given.unionByName(won)
        waiting = kept(waiting.join(won.select(entity), entity, "left_anti"), "waiting")
        if waiting.isEmpty():
            return given
    raise RuntimeError("entities are left without a surrogate: their format has too few values")


def _in_format(kind: Column, mention: Column, surrogate: Column, by_last: Column) -> Column:
    """The surrogate's normal form written as the mention is: punctuation, case and title.

    ``by_last`` says that the mention is the last word of a name.
    """
    chars = F.split(mention, "")

    def digits_before(i: Column) -> Column:
        return F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), "[^0-9]", ""))
    written = F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(surrogate, digits_before(i) + 1, F.lit(1))).otherwise(c)), "")
    more = F.substring(surrogate, digits_before(F.length(mention)) + 1, F.length(surrogate))
    title = F.regexp_extract(mention, _TITLED, 0)
    parts = F.regexp_extract_all(surrogate, F.lit(r"([\x20-]|[^\x20-]+)"), 1)
    parts = F.transform(parts, lambda w: F.when(w.isin(*PARTICLES), w).otherwise(F.initcap(w)))
    name = F.when(by_last, F.element_at(parts, -1)).otherwise(F.concat(title, F.array_join(parts, "")))
    big = (F.upper(mention) == mention) & (F.lower(mention) != mention)
    return F.when(kind == "mail", F.when(big, F.upper(surrogate)).otherwise(surrogate)) \
        .when(kind == "ip", surrogate).when(kind == "name", name).otherwise(F.concat(written, more))


def _names(mentions: Column) -> Column:
    """``full``, ``last`` word and ``gender`` of each mention that is a name after a title."""
    titled = F.filter(mentions, lambda m: kind_of(m) == "name")
    return F.transform(titled, lambda m: F.struct(
        _bare(m).alias("full"), F.regexp_extract(_bare(m), _LAST, 0).alias("last"), _gender(m).alias("gender")))


def _again(names: Column) -> Column:
    """The pattern of all entities and of the text's names without their titles."""
    words = F.filter(F.array_distinct(F.concat(
        F.transform(names, lambda n: n["full"]), F.transform(names, lambda n: n["last"]))),
        lambda w: F.length(w) > 1)
    # In reverse order a name stands before those it begins with.
    words = F.array_join(F.reverse(F.array_sort(F.transform(words, lambda w: F.replace(
        w, F.lit("."), F.lit("[.]"))))), "|")
    return F.when(words == "", F.lit(f"({ANY})")).otherwise(F.concat(
        F.lit(rf"({ANY}|(?<![\p{{L}}\p{{M}}'’])(?:"), words, F.lit(r")(?![\p{L}\p{M}]))")))


def _entity(mention: Column, names: Column) -> Column:
    """``mention``, ``kind``, ``form``, ``gender``, ``by_last``; without a title those of the text's name."""
    kind = kind_of(mention)
    whole = F.get(F.filter(names, lambda n: n["full"] == mention), F.lit(0))
    last = F.get(F.filter(names, lambda n: n["last"] == mention), F.lit(0))
    of = F.coalesce(whole, last)
    return F.struct(
        mention.alias("mention"), F.coalesce(kind, F.lit("name")).alias("kind"),
        F.when(kind.isNull(), F.lower(of["full"])).otherwise(normal_form(kind, mention)).alias("form"),
        F.when(kind.isNull(), of["gender"]).otherwise(_gender(mention)).alias("gender"),
        (kind.isNull() & whole.isNull()).alias("by_last"))


def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` with surrogates, ``n_entities``, ``spans`` of each row.

    ``spans`` lists ``kind:start:end`` of each surrogate in the new text (code points, end
    exclusive). The same ``key`` gives the same surrogates for the same corpus. Null and empty texts
    stay as they are. Repeated rows give repeated results, with ids null or not.
    """
    rows = texts(docs, id_col, text_col)
    has = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    hits = kept(rows.where(has).select("doc_id", "text", F.md5("text").alias("of"), F.regexp_extract_all(
        "text", F.lit(f"({ANY})"), 1).alias("mentions")), "hits")
    hits = hits.withColumn("names", _names(F.col("mentions"))).withColumn("pattern", _again(F.col("names")))
    again = F.when(F.size("names") > 0, F.regexp_extract_all("text", F.col("pattern"), 1)) \
        .otherwise(F.col("mentions"))
    found = kept(hits.select("of", "names", again.alias("mentions")).dropDuplicates(["of"]), "mentions")
    each = found.select("of", "names", F.posexplode("mentions").alias("place", "mention")).select(
        "of", "place", _entity(F.col("mention"), F.col("names")).alias("e")).select("of", "place", "e.*")
    entity = ["kind", "form", "gender"]
    given = surrogates(kept(each.select(entity).distinct(), "entities"), key)
    placed = each.join(given, entity).select("of", F.struct("place", "kind", _in_format(
        *[F.col(c) for c in ("kind", "mention", "surrogate", "by_last")]).alias("written")).alias("new"))
    per_text = placed.groupBy("of").agg(F.array_sort(F.collect_list("new")).alias("new"))
    parts = F.transform(F.split("text", F.col("pattern")), lambda g, i: F.struct(
        g.alias("gap"), F.coalesce(F.get("new", i)["written"], F.lit("")).alias("written")))
    out = hits.join(per_text, "of").select("doc_id", "new", parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["gap"], p["written"])), "")
    lengths = F.transform("parts", lambda p: F.struct(
        F.length(p["gap"]).alias("gap"), F.length(p["written"]).alias("own")))
    ends = F.aggregate(lengths, F.array().cast("array<int>"), lambda seen, p: F.concat(seen, F.array(
        F.coalesce(F.get(seen, F.size(seen) - 1), F.lit(0)) + p["gap"] + p["own"])))
    spans = F.transform("new", lambda n, i: F.concat_ws(
        ":", n["kind"], F.get("ends", i) - F.length(n["written"]), F.get("ends", i)))
    changed = out.select("doc_id", text.alias("text"), "new", ends.alias("ends")).select(
        "doc_id", "text", F.size("new").cast("long").alias("n_entities"),
        F.array_join(spans, ",").alias("spans"))
    same = rows.where(~has).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"),
                                   F.lit("").alias("spans"))
    return changed.unionByName(same)
