"""Surrogates for personal data, with DataFrame and SQL functions only.

Entities are found by one pattern: e-mail addresses, secrets (values after words
like "token =", long hexadecimal strings), IPv4 addresses, card and account
numbers, phone numbers, social security numbers and names after a form of
address. What such a name is made of is then found again where it stands bare in
the same text: given name, family name, in any order, or the initial of a given
name before another name. Each is replaced by a surrogate of its kind:

* keyed: drawn from the HMAC-SHA256 of the entity, so that without the key
  nothing leads back;
* matching format: the same length, separators, letter case and character
  classes; card numbers stay valid or invalid by their check digit, IP numbers
  stay in range, phone numbers keep their country code, addresses their top-level domain;
* matching gender and script: names take endings of the gender that the form of
  address tells (none after a title such as Dr), in the script of the name; a Cyrillic
  or Greek family name is one entity in its male and its female form;
* coreferent: an entity has one surrogate in the whole corpus, however it is
  written (letter case, separators, with or without country code or given name);
* distinct: surrogates of different entities differ, and none equals any entity of
  the corpus. Entities that collide draw again until none does.

Only distinct entities are drawn for, and only documents with entities are
joined with them; all other documents pass by without a shuffle.

Defined results: null and empty texts stay as they are; repeated rows and copies
get equal replacements; an empty table gives an empty result; columns besides the
text pass through unchanged, whatever their names. A bare word that is a given name
of one person and the family name of another in its text is taken as the family
name; of several given names with one initial, the least lends its own. Bare names
in Han script, which has no word bounds, and names in lower case are not found.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import all_but, discard, free_names, quoted, stage

#: Forms of address by gender.
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle", "Госпожа", "Κυρία")
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος")
#: Titles that tell no gender.
NEUTRAL = ("Dr", "Prof")
#: Words that begin sentences: none of them belongs to the name before it.
STARTERS = ("A", "After", "All", "An", "And", "As", "At", "Before", "But", "By", "For", "From", "He", "Her", "His", "How", "I", "If", "In", "It", "My", "No", "Not", "Of", "On", "Or",
            "Our", "She", "So", "That", "The", "Then", "There", "They", "This", "To", "We", "What", "When", "Where", "Who", "Why", "Yes", "You")
TITLES = sorted({*FEMALE, *MALE, *NEUTRAL}, key=len, reverse=True)
_CAPITAL_TITLES = [x.upper() for x in TITLES]
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_STARTER = rf"(?!(?i:{'|'.join(STARTERS)})(?![\p{{L}}\p{{M}}]))"
#: Smith, O'Brien, McDonald; SMITH, O'BRIEN; 李娜; J.
_NAME = rf"{_STARTER}(?:\p{{Lu}}['’]|Ma?c)?\p{{Lu}}[\p{{Ll}}\p{{M}}]{{1,40}}"
_CAPITALS = rf"{_STARTER}(?:\p{{Lu}}['’])?\p{{Lu}}{{2,40}}"
_HAN, _INITIAL = r"\p{IsHan}{1,4}", r"\p{Lu}\."
#: Kinds in the order in which they are tried at a place. Quantifiers are bounded
#: or possessive, so that long texts cost time in proportion to their length.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": r"(?<![\p{L}\p{N}])(?i:token|secret|password|passwd|api[_-]?key)[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']?[A-Za-z0-9_+/-]{8,}+(?:\.[A-Za-z0-9_+/-]++)*+|(?<![\p{L}\p{N}])(?=[A-Fa-f]{0,31}[0-9])[0-9A-Fa-f]{32,}+(?![\p{L}\p{N}])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\p{{N}})",
    "phone": r"(?<![\p{L}\p{N}+])\+?[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\p{N})|(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?!\p{N})"
    r"|(?<![\p{L}\p{N}.])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?!\p{N})|(?<![\p{L}\p{N}.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\p{N}-])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![\p{L}\p{N}])",
    "name": rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? (?:(?:{_INITIAL} ?){{0,2}}{_NAME}(?:[ -]{_NAME}){{0,2}}(?!\p{{L}})|{_HAN})|(?:{'|'.join(_CAPITAL_TITLES)})\. (?:{_INITIAL} ?){{0,2}}{_CAPITALS}(?:[ -]{_CAPITALS})?(?!\p{{L}}))",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A name that stands without a form of address, or an initial before a name.
BARE = rf"(?<![\p{{L}}\p{{M}}])(?:{_NAME}|{_CAPITALS})(?![\p{{L}}\p{{M}}])|(?<![\p{{L}}\p{{M}}]){_INITIAL}(?= ?\p{{Lu}})"
_WHOLE_BARE = rf"\A(?:{_NAME}|{_CAPITALS}|{_INITIAL})\z"
#: What every entity holds at least: a text without it needs no closer look.
HINT = "[0-9@:=]|" + "|".join(f"{first}(?:{'|'.join(sorted({x[1:] for x in (*TITLES, *_CAPITAL_TITLES) if x[0] == first}))})[. ]" for first in sorted({x[0] for x in TITLES}))
#: Syllables of drawn names by script, and their endings by gender.
SYLLABLES = {"latin": "ba be do fa ga hu ka le lo ma mi na no pe ra ri sa so ta ve wi za", "cyrillic": "ба ве го да жи ка ле ма ни по ра са та фе", "greek": "βα γε δι κα λε μα νι πο ρα σα τα φε", "han": "安 白 成 东 方 高 海 江 林 明 平 山 天 文 星 云"}
ENDINGS = {
    "latin": {"female": "na lia ria", "male": "nus ton rik", "any": "el en is", "surname": "man ner sen lin"},
    "cyrillic": {"female": "на лия ра", "male": "мир лав тин", "any": "ша ня ля", "surname": "ев ин ов"},
    "greek": {"female": "να λία ρα", "male": "νος λης ρος", "any": "λις νις", "surname": "ίδης άκης"},
    "han": {"female": "芳 丽 娟", "male": "刚 强 军", "any": "宁 华 晨"},
}
#: Female endings of family names, the male ones and what they are added to.
FEMALE_SURNAMES = {"cyrillic": (r"(ов|ев|ёв|ин|ын)а\z", "$1", r"\z", "а"), "greek": (r"η\z", "ης", r"ς\z", "")}
#: Rounds of drawing anew; from RELAX on, lengths may change, so that a full space cannot block.
ROUNDS, RELAX = 64, 12
LETTERS, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"


def kind_of(mention: Column) -> Column:
    is_name = mention.rlike(rf"\A(?:{PATTERNS['name']})\z")
    out = F.when(mention.contains("@"), "email").when(is_name, "name")
    out = out.when(mention.rlike(r"\A[0-9A-Fa-f]{32,}+\z"), "secret")
    for kind in ("ip", "ssn"):
        out = out.when(mention.rlike(rf"\A(?:{PATTERNS[kind]})\z"), kind)
    return out.when(mention.rlike(rf"\A(?:{PATTERNS['card']})\z"), "card").when(mention.rlike(r"\A[0-9+(]") & mention.rlike(r"\A[0-9+() .-]+\z"), "phone").otherwise("secret")


def script_of(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").when(text.rlike(r"\p{IsHan}"), "han").otherwise("latin")


def parts_of(mention: Column) -> Column:
    """A mention's entities: structs of kind, canonical form and the piece of the
    mention that it replaces; the rest of the mention stays."""
    kind = kind_of(mention)
    digits = F.regexp_replace(mention, "[^0-9]", "")
    value = F.regexp_extract(mention, r"([A-Za-z0-9_+/-]++(?:\.[A-Za-z0-9_+/-]++)*+)\z", 1)
    hexadecimal = value.rlike(r"\A[0-9A-Fa-f]+\z")

    def one(kind_name, canonical, piece):
        return F.array(F.struct(kind_name.alias("kind"), canonical.alias("canonical"), piece.alias("piece"), F.lit(False).alias("feminine")))

    title = F.regexp_extract(mention, r"\A([^. ]+)", 1)
    female = title.isin(*FEMALE, *(x.upper() for x in FEMALE))
    gender = F.when(female, "female").when(title.isin(*MALE, *(x.upper() for x in MALE)), "male").otherwise("any")
    names = F.regexp_extract_all(F.regexp_replace(mention, r"\A[^. ]+\.? ", ""), F.lit(r"([\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)?)"), F.lit(1))

    def name_part(x, i):
        script = script_of(x)
        surname = (i == F.size(names) - 1) & (script != "han")
        canonical, feminine = F.lower(x), F.lit(False)
        for of, (ending, male, _, _) in FEMALE_SURNAMES.items():
            inflected = surname & (script == of) & (female | canonical.rlike(ending))
            canonical, feminine = F.when(inflected, F.regexp_replace(canonical, ending, male)).otherwise(canonical), feminine | inflected
        return F.struct(F.concat_ws(".", F.lit("name"), script, F.when(surname, "surname").otherwise(gender)).alias("kind"), canonical.alias("canonical"), x.alias("piece"), feminine.alias("feminine"))

    named = F.transform(names, name_part)
    secret = one(F.when(hexadecimal, "hex").otherwise("secret"), F.when(hexadecimal, F.lower(value)).otherwise(value), value)
    return (F.when(kind == "name", named).when(kind == "email", one(kind, F.lower(mention), mention)).when(kind == "secret", secret)
            .when(kind == "phone", one(kind, F.when(F.length(digits) >= 10, F.substring(digits, -10, 10)).otherwise(digits), mention))
            .when(kind == "ip", one(kind, mention, mention)).otherwise(one(kind, digits, mention)))


def _pick(seed: Column, i: Column, chars: str) -> Column:
    return F.substring(F.lit(chars), (F.pmod(F.xxhash64(seed, i), F.lit(len(chars))) + 1).cast("int"), F.lit(1))


def _between(seed: Column, i: Column, low: int, n: int) -> Column:
    return (F.pmod(F.xxhash64(seed, i), F.lit(n)) + low).cast("string")


def _like(seed: Column, text: Column, alphabet: str | None = None) -> Column:
    """Another text of the same length and character classes."""
    def char(c, i):
        if alphabet:
            return _pick(seed, i, alphabet)
        return F.when(c.rlike("[0-9]"), _pick(seed, i, DIGITS)).when(c.rlike(r"\p{Lu}"), F.upper(_pick(seed, i, LETTERS))).when(c.rlike(r"\p{L}"), _pick(seed, i, LETTERS)).otherwise(c)
    return F.array_join(F.transform(F.split(text, ""), char), "")


def keyed_hash(message: Column, key: str) -> Column:
    """HMAC-SHA256 of a text as hexadecimal digits."""
    block = key.encode()
    block = (hashlib.sha256(block).digest() if len(block) > 64 else block).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def surrogate_of(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The surrogate that an attempt draws for an entity, in canonical form."""
    seed = keyed_hash(F.concat_ws("\u0001", kind, attempt.cast("string"), canonical), key)
    relaxed = attempt >= RELAX
    more = F.when(relaxed, _like(F.concat(seed, F.lit("+")), F.lit("a0a0a0"))).otherwise("")
    tld = F.regexp_extract(canonical, r"(\.\p{L}+)\z", 1)
    email = F.concat(more, _like(seed, canonical.substr(F.lit(1), F.length(canonical) - F.length(tld))), tld)

    def octet(o, i):
        n = F.when(relaxed, 3).otherwise(F.length(o))
        return F.when(n == 1, _between(seed, i, 0, 10)).when(n == 2, _between(seed, i, 10, 90)).otherwise(_between(seed, i, 100, 156))

    ip = F.array_join(F.transform(F.split(canonical, r"\."), octet), ".")
    digits = _like(seed, canonical, DIGITS)
    leading = F.array_join(F.transform(F.split(canonical, ""), lambda c, i: F.when((i == 0) | (i == 3), _pick(seed, i, DIGITS[2:])).otherwise(_pick(seed, i, DIGITS))), "")
    body = F.concat(F.substring(canonical, 1, 1), digits.substr(F.lit(2), F.length(canonical) - 2))
    luhn = lambda x: F.call_function("luhn_check", x)
    fitting = F.filter(F.transform(F.split(F.lit(DIGITS), ""), lambda d: F.concat(body, d)), lambda x: luhn(x) == luhn(canonical))
    card = F.element_at(fitting, (F.pmod(F.xxhash64(seed, F.lit("check")), F.size(fitting)) + 1).cast("int"))

    def name(script: str, role: str) -> Column:
        syllables, endings = SYLLABLES[script].split(" "), ENDINGS[script][role].split(" ")
        at = lambda i, words: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64(seed, i), F.lit(len(words))) + 1).cast("int"))
        stem = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + F.floor(attempt / 2).cast("int")), lambda i: at(i, syllables)), "")
        return F.concat(stem, at(F.lit(0), endings))

    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "hex", F.concat(F.when(canonical.rlike(r"\A[0-9]+\z"), digits).otherwise(_like(seed, canonical, HEX)), F.regexp_replace(more, "[^0-9a-f]", "0")))
    out = out.when(kind == "secret", F.concat(_like(seed, canonical), more)).when(kind == "phone", leading).when(kind == "card", card).when(kind == "ssn", digits)
    for script in SYLLABLES:
        for role in ENDINGS[script]:
            out = out.when(kind == f"name.{script}.{role}", name(script, role))
    return out


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) of distinct entities: distinct inside a kind, and no entity."""
    entities = stage(entities.select("kind", "canonical").distinct(), "entities", narrow=True)
    taken = entities.select("kind", F.col("canonical").alias("surrogate"))
    pending, done = entities, []
    for attempt in range(ROUNDS):
        drawn = pending.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("canonical"), F.lit(attempt), key))
        # Of those that draw alike, the least keeps it, unless it is an entity or given away.
        won = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).join(taken, ["kind", "surrogate"], "left_anti")
        for earlier in done:
            won = won.join(earlier, ["kind", "surrogate"], "left_anti")
        won = stage(won.select("kind", "canonical", "surrogate"), "surrogates", narrow=True)
        done.append(won)
        rest = stage(pending.join(won, ["kind", "canonical"], "left_anti"), "entities", narrow=True)
        if pending is not entities:
            discard(pending)
        pending = rest
        if pending.isEmpty():
            discard(pending)
            out = done[0]
            for more in done[1:]:
                out = out.union(more)
            return out
    raise RuntimeError(f"some surrogates still collide after {ROUNDS} rounds")


def _in_case(piece: Column, name: Column) -> Column:
    """A name in the letter case of the piece that it replaces, cut to an initial where that is one."""
    initial = (F.length(piece) == 1) & ~piece.rlike(r"\p{IsHan}")
    return F.when(initial, F.upper(F.substring(name, 1, 1))).when((F.length(piece) > 1) & (piece == F.upper(piece)), F.upper(name)).otherwise(F.initcap(name))


def _in_format(kind: Column, piece: Column, surrogate: Column, feminine: Column) -> Column:
    """The surrogate in the format of the piece that it replaces."""
    inflected = surrogate
    for script, (_, _, ending, female) in FEMALE_SURNAMES.items():
        inflected = F.when(feminine & (kind == f"name.{script}.surname"), F.regexp_replace(surrogate, ending, female)).otherwise(inflected)
    digits = F.regexp_replace(piece, "[^0-9]", "")
    # The last digits of the piece are replaced; what stands before is a country code.
    kept = F.length(digits) - F.length(surrogate)
    chars = F.split(piece, "")
    seen = F.transform(chars, lambda c, i: F.length(F.regexp_replace(piece.substr(F.lit(1), i + 1), "[^0-9]", "")))
    numbers = F.array_join(F.zip_with(chars, seen, lambda c, n: F.when(c.rlike("[0-9]") & (n > kept), surrogate.substr((n - kept).cast("int"), F.lit(1))).otherwise(c)), "")
    cased = F.when(piece == F.lower(piece), surrogate).when(piece == F.upper(piece), F.upper(surrogate)).otherwise(
        F.array_join(F.zip_with(F.split(surrogate, ""), chars, lambda c, p: F.when(p.rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), ""))
    return (F.when(kind.isin("phone", "card", "ssn"), numbers).when(kind.startswith("name."), _in_case(piece, inflected)).when(kind.isin("email", "hex"), cased).otherwise(surrogate))


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text", count_as: str | None = None) -> DataFrame:
    """``docs`` with every entity in the text replaced; ``count_as`` names a new
    column for the number of replaced places (an old one of that name gives way)."""
    names = all_but(docs, count_as)
    text = F.col(quoted(text_column))
    id_, at_, between_, new_, bare_ = free_names(docs.columns, "__key", "__places", "__gaps", "__new", "__bare")
    found = F.coalesce(F.rlike(text, F.lit(HINT)) & F.rlike(text, F.lit(ANY)), F.lit(False))
    clean, touched = docs.where(~found), docs.where(found)
    # Texts with a name are also cut at every bare name, to see which of them are known.
    named = text.rlike(PATTERNS["name"])

    def at_entities(how):
        return F.when(named, how(f"{ANY}|{BARE}")).otherwise(how(ANY))

    places = at_entities(lambda pattern: F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)))
    by_text = touched.select(F.xxhash64(text).alias("key"), F.filter(F.array_distinct(places), lambda m: ~m.rlike(_WHOLE_BARE)).alias("mentions")).dropDuplicates(["key"])
    mentions = by_text.select("key", F.explode("mentions").alias("mention"))
    parts = stage(mentions.select("key", "mention", F.posexplode(parts_of(F.col("mention"))).alias("place", "part")).select("key", "mention", "place", "part.*"), "mentions", narrow=True, dealt=True)
    drawn = draw_surrogates(parts, key)
    written = parts.join(drawn, ["kind", "canonical"]).select("key", "mention", "place", "piece", "kind", _in_format(F.col("kind"), F.col("piece"), F.col("surrogate"), F.col("feminine")).alias("new"))
    # A mention is its pieces and what stands between; it has at most five pieces.
    whole = written.groupBy("key", "mention").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "new", "kind"))).alias("pieces"))
    start = F.struct(F.lit("").alias("out"), F.col("mention").alias("rest"))

    def put(state, p):
        at = F.call_function("instr", state["rest"], p["piece"])
        return F.struct(F.concat(state["out"], state["rest"].substr(F.lit(1), at - 1), p["new"]).alias("out"),
                        state["rest"].substr(at + F.length(p["piece"]), F.length(state["rest"])).alias("rest"))

    replaced = whole.select("key", "mention", "pieces", F.aggregate("pieces", start, put, lambda s: F.concat(s["out"], s["rest"])).alias("new"))
    # What a text's names are made of: word (or the initial of a given name, last in order) and new name.
    surname = lambda p: p["kind"].endswith(".surname")
    full = F.transform(F.filter("pieces", lambda p: p["kind"].startswith("name.") & (F.length(p["piece"]) > 1)), lambda p: F.struct(
        F.lower(p["piece"]).alias("word"), F.when(surname(p), 0).otherwise(1).alias("rank"), F.lower(p["new"]).alias("new")))
    initials = F.transform(F.filter("pieces", lambda p: p["kind"].startswith("name.") & ~surname(p)), lambda p: F.struct(
        F.concat(F.lower(F.substring(p["piece"], 1, 1)), F.lit(".")).alias("word"), F.when(F.length(p["piece"]) == 1, 0).otherwise(1).alias("rank"), F.lower(p["new"]).alias("new")))
    per_text = replaced.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias(new_), F.array_sort(F.flatten(F.collect_set(F.concat(full, initials)))).alias("names"))
    # Of the entries of a word, the first in order stays.
    firsts = F.filter("names", lambda x, i: (i == 0) | (F.get("names", i - 1)["word"] != x["word"]))
    per_text = per_text.select(F.col("key").alias(id_), new_, F.map_from_entries(F.transform(firsts, lambda x: F.struct(x["word"], x["new"]))).alias(bare_))
    # The texts are cut into mentions and what stands between before they move.
    cut = touched.withColumns({id_: F.xxhash64(text), at_: places, between_: at_entities(lambda pattern: F.split(text, pattern, -1))})
    keyed = cut.drop(text_column).join(per_text, id_)
    at, between = F.col(at_), F.col(between_)

    def known(m):  # a bare name's surrogate, in its letter case; null for other words
        name = F.col(bare_)[F.lower(m)]
        return F.when(m.endswith("."), F.concat(F.upper(F.substring(name, 1, 1)), F.lit("."))).otherwise(_in_case(m, name))

    def new(m):
        return F.coalesce(F.col(new_)[m], F.when(m.rlike(_WHOLE_BARE), F.coalesce(known(m), m)), F.raise_error(F.lit("a mention has no surrogate: the documents have changed since it was found")).cast("string"))

    filled = F.concat(F.array_join(F.zip_with(F.slice(between, 1, F.size(at)), at, lambda g, m: F.concat(g, new(m))), ""), F.element_at(between, -1))
    hits = F.filter(at, lambda m: F.col(new_)[m].isNotNull() | F.col(bare_)[F.lower(m)].isNotNull())
    counted = [F.size(hits).cast("long").alias(count_as)] if count_as else []
    done = keyed.select(*(filled.alias(c) if c == text_column else F.col(quoted(c)) for c in names), *counted)
    return clean.select(*map(quoted, names), *([F.lit(0).cast("long").alias(count_as)] if count_as else [])).unionByName(done)
