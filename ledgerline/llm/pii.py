"""PII surrogates, in DataFrame and SQL functions only.

One pattern finds e-mail addresses, IPv4 addresses, social security numbers,
IBANs, payment cards (valid check digit), phone numbers and names after a
title. Every entity - its kind and canonical form, so that differently written
mentions are one entity - gets a surrogate from a SHA-256 of the key, the
kind, the canonical form and an attempt number: digits become digits, cards
keep their first digit and get a right check digit, phone numbers keep their
country code if seven digits or more follow it, addresses stay addresses,
names (all capitalised words after the titles) keep titles, gender (from the
first title, neutral ones included), script and number of words. Each mention
keeps its own separators.

Distinctness is checked over all entities of the corpus: where two entities
get one surrogate, or a surrogate is itself an entity of the corpus, all but
the first try again with the next attempt, until none is left. Entities with
attempt 0 - nearly all - need no lookup, so only documents that hold one of
the others get a row in the lookup table, whose size decides how Spark joins it.

Defined cases: a null text stays null, texts without entities stay as they
are; very long texts are treated whole; repeated rows and rows with a null
doc_id get the same text each; an empty table gives no rows; only doc_id and
text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import materialise, read

KEY = "surrogate-key"

# Titles by gender, and the parts that surrogate names are made of, by script.
MALE = "Mr|Sir|Herr|Herrn|Monsieur|Señor|Don|господин|г-н"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Señorita|Doña|госпожа|г-жа"
NEUTRAL = "Dr|Doctor|Prof|Professor|Mx|доктор|профессор"
LATIN = "bel cor dan el fen gar hal in jor kal lin mar nor ol per quin ros sel tam ul ven wil yor zan".split()
CYRILLIC = "бел вор гор дан ел жан зор иг кал лин мар нор ол пер рос сел там ул фен хал чар шур юл яр".split()
LATIN_ENDINGS = {"m": "o on us ert".split(), "f": "a ia elle ine".split(), "n": "in el an is".split(), "s": "er mann ley ez".split()}
CYRILLIC_ENDINGS = {"m": "ан ей ил ор".split(), "f": "ана ия ина елла".split(), "n": "ай ень ис эль".split(), "s": "ко ич ук ян".split()}

#: Labels are taken for good, up to the next one that begins with two letters, so long domains need no stack.
_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
          r"@(?:(?:[A-Za-z0-9-]++\.(?![A-Za-z]{2}))*+[A-Za-z0-9-]++\.(?=[A-Za-z]{2}))++[A-Za-z]{2,}")
_IP = r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9A-Za-z])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
_CARD = r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}(?:[ -]?[0-9]{1,7})(?![0-9A-Za-z])"
_PHONE = (r"(?<![0-9A-Za-z+(])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
          r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])")
_TITLE = rf"(?:{FEMALE}|{MALE}|{NEUTRAL})\.? (?:(?:{NEUTRAL})\.? )*+"
#: A capital with further letters, also capitals and after apostrophes; or an initial, if a name goes on after it.
_PART = r"(?:\p{Lu}(?:['’]?[\p{L}\p{M}])++|\p{Lu}\.?(?=[ -]\p{Lu}))"
_NAME = rf"(?<![\p{{L}}]){_TITLE}{_PART}(?:[ -]{_PART})*+"
#: Country codes, where enough digits follow to keep numbers apart.
_CODE = r"^[+](?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})(?=[0-9]{7})"
PATTERN = "|".join((_EMAIL, _IP, _SSN, _IBAN, _CARD, _PHONE, _NAME))

KINDS = "email ip ssn iban card phone name".split()


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind(v: str) -> str:
    """SQL: the kind of a match, null for one that is none (a number without a right check digit)."""
    digits = f"regexp_replace({v}, '[^0-9]', '')"
    return (f"case when {v} like '%@%' then 'email' when {v} rlike '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$' then 'ip'"
            f" when {v} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then 'ssn' when {v} rlike '^[A-Z]{{2}}[0-9]{{2}}' then 'iban'"
            f" when {v} rlike '^[0-9]{{4}}[ -]?[0-9]{{4}}[ -]?[0-9]{{4}}[ -]?[0-9]{{1,7}}$' then if(luhn_check({digits}), 'card', null)"
            f" when {v} rlike '[0-9]' then 'phone' else 'name' end")


def _bare(v: str) -> str:
    """SQL: a name without its titles."""
    return f"regexp_replace({v}, {_sql('^' + _TITLE)}, '')"


def gender(v: str) -> str:
    return f"case when {v} rlike {_sql(f'^(?:{FEMALE})[. ]')} then 'f' when {v} rlike {_sql(f'^(?:{NEUTRAL})[. ]')} then 'n' else 'm' end"


def canonical(v: str, of: str) -> str:
    """SQL: what all mentions of one entity share."""
    return (f"case {of} when 'email' then lower({v}) when 'name' then concat({gender(v)}, ':', lower({_bare(v)}))"
            f" when 'ip' then {v} when 'iban' then replace({v}, ' ', '') when 'phone' then regexp_replace({v}, '[^+0-9]', '') else regexp_replace({v}, '[^0-9]', '') end")


def digest(of: str, entity: str, attempt: str) -> str:
    return f"sha2(concat_ws('|', {_sql(KEY)}, {of}, {entity}, cast({attempt} as string)), 256)"


def _number(h: str, i: str) -> str:
    """SQL: the i-th two-digit number (0 to 255) of a digest, around the end."""
    return f"cast(conv(substring({h}, 2 * pmod({i}, 32) + 1, 2), 16, 10) as int)"


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(_sql(w) for w in words) + ")"


def _signs(v: str, h: str) -> str:
    """SQL: letters become letters of their case, digits digits, all else stays."""
    return (f"array_join(transform(split({v}, ''), (c, i) -> case when c rlike '[0-9]' then cast({_number(h, 'i')} % 10 as string)"
            f" when c rlike '[a-z]' then char(97 + {_number(h, 'i')} % 26) when c rlike '[A-Z]' then char(65 + {_number(h, 'i')} % 26)"
            f" else c end), '')")


def _word(h: str, last: str, entity: str, i: str, attempt: str) -> str:
    """SQL: one surrogate name word; later attempts are longer, so their number is never exhausted."""
    def build(parts: list[str], endings: dict[str, list[str]]) -> str:
        ending = (f"case when {last} then element_at({_array(endings['s'])}, {_number(h, f'9 * {i} + 8')} % 4 + 1)"
                  f" when {entity} like 'f:%' then element_at({_array(endings['f'])}, {_number(h, f'9 * {i} + 8')} % 4 + 1)"
                  f" when {entity} like 'n:%' then element_at({_array(endings['n'])}, {_number(h, f'9 * {i} + 8')} % 4 + 1)"
                  f" else element_at({_array(endings['m'])}, {_number(h, f'9 * {i} + 8')} % 4 + 1) end")
        body = (f"array_join(transform(sequence(0, 1 + least({attempt}, 5)), j ->"
                f" element_at({_array(parts)}, {_number(h, f'9 * {i} + j')} % {len(parts)} + 1)), '')")
        return f"initcap(concat({body}, {ending}))"

    return f"if({entity} rlike '[а-яё]', {build(CYRILLIC, CYRILLIC_ENDINGS)}, {build(LATIN, LATIN_ENDINGS)})"


def core(of: str, entity: str, attempt: str) -> str:
    """SQL: the surrogate's canonical form."""
    h = digest(of, entity, attempt)
    luhn = ("pmod(10 - pmod(aggregate(transform(reverse(split(b, '')), (c, i) -> if(i % 2 = 0,"
            " if(cast(c as int) > 4, 2 * cast(c as int) - 9, 2 * cast(c as int)), cast(c as int))), 0, (s, x) -> s + x), 10), 10)")
    body = f"concat(substring({entity}, 1, 1), substring({_signs(entity, h)}, 2, length({entity}) - 2))"
    card = f"element_at(transform(array({body}), b -> concat(b, cast({luhn} as string))), 1)"
    octets = f"array_join(transform(split({entity}, '[.]'), (o, i) -> cast(1 + {_number(h, 'i')} % 223 as string)), '.')"
    local = f"substring_index({entity}, '@', 1)"
    # Later attempts bring further numbers: one-sign names at many domains never run out.
    hosts = f"array_join(transform(sequence(0, least({attempt}, 12)), j -> cast({_number(h, '31 - j')} as string)), '-')"
    email = f"concat({_signs(local, h)}, '@mail', {hosts}, '.example.net')"
    words = f"split(substring({entity}, 3), '[ -]')"
    name = (f"concat(substring({entity}, 1, 2), array_join(transform({words}, (w, i) ->"
            f" lower({_word(h, f'i = size({words}) - 1', entity, 'i', attempt)})), ' '))")
    iban = f"concat(substring({entity}, 1, 2), {_signs(f'substring({entity}, 3)', h)})"
    code = f"regexp_extract({entity}, {_sql(_CODE)}, 0)"
    phone = f"concat({code}, substring({_signs(entity, h)}, length({code}) + 1))"
    return (f"case {of} when 'card' then {card} when 'ip' then {octets} when 'email' then {email} when 'phone' then {phone}"
            f" when 'name' then {name} when 'iban' then {iban} else {_signs(entity, h)} end")


def dressed(v: str, of: str, made: str) -> str:
    """SQL: the surrogate in the form of the mention: its separators and titles."""
    nth = "length(regexp_replace(substring({v}, 1, i + 1), '[^0-9A-Z]', ''))".format(v=v)
    plain = f"ltrim('+', {made})"
    signs = f"array_join(transform(split({v}, ''), (c, i) -> if(c rlike '[0-9A-Z]', substring({plain}, {nth}, 1), c)), '')"
    name = f"concat(regexp_extract({v}, {_sql('^' + _TITLE)}, 0), initcap(substring({made}, 3)))"
    return f"case {of} when 'email' then {made} when 'ip' then {made} when 'name' then {name} else {signs} end"


def entities(docs: DataFrame) -> DataFrame:
    """(kind, entity) of all distinct entities."""
    found = docs.select(F.explode(F.expr(f"regexp_extract_all(text, {_sql(PATTERN)}, 0)")).alias("v")).distinct()
    return found.withColumn("kind", F.expr(kind("v"))).where("kind is not null").withColumn(
        "entity", F.expr(canonical("v", "kind"))).select("kind", "entity").distinct()


def retried(found: DataFrame) -> DataFrame:
    """(kind, entity, attempt) of the entities whose first surrogate was taken."""
    now = materialise(found.withColumn("attempt", F.lit(0)).withColumn("core", F.expr(core("kind", "entity", "0"))))
    real = now.select("kind", F.col("entity").alias("core"))
    while True:
        first = now.groupBy("kind", "core").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n"))
        twice = first.where("n > 1").select("kind", "core", "first.entity").withColumnRenamed("entity", "keeps")
        clash = now.join(twice, ["kind", "core"]).where("entity <> keeps").select("kind", "entity").unionByName(
            now.join(real, ["kind", "core"], "left_semi").select("kind", "entity")).distinct()
        clash = materialise(clash)
        if clash.isEmpty():
            return now.where("attempt > 0").select("kind", "entity", "attempt")
        again = now.join(clash, ["kind", "entity"]).select("kind", "entity", F.expr("attempt + 1").alias("attempt"))
        again = again.withColumn("core", F.expr(core("kind", "entity", "attempt")))
        now = materialise(now.join(clash, ["kind", "entity"], "left_anti").unionByName(again.select(now.columns)))


def surrogates(docs: DataFrame) -> DataFrame:
    """doc_id, text with surrogates, n_entities and their kinds, for every row of ``docs``."""
    texts = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-1)).alias("k"), F.xxhash64("text").alias("t"))
    again = materialise(retried(entities(docs)))
    found = F.expr(f"regexp_extract_all(text, {_sql(PATTERN)}, 0)")
    if again.isEmpty():
        rows = texts.withColumn("tries", F.lit(None).cast("map<string,int>"))
    else:
        held = texts.select("k", "t", F.explode(found).alias("v")).withColumn("kind", F.expr(kind("v"))).where("kind is not null")
        held = held.withColumn("entity", F.expr(canonical("v", "kind"))).join(again, ["kind", "entity"])
        held = held.select("k", "t", F.concat_ws("|", "kind", "entity").alias("e"), "attempt").distinct()
        tries = materialise(held.groupBy("k", "t").agg(F.map_from_entries(F.collect_list(F.struct("e", "attempt"))).alias("tries")))
        rows = texts.join(tries, ["k", "t"], "left")
    attempt = "coalesce(tries[concat_ws('|', x.kind, x.entity)], 0)"
    rows = rows.select("doc_id", "text", "tries", found.alias("found"))
    rows = rows.withColumn("found", F.expr(f"transform(found, v -> named_struct('v', v, 'kind', {kind('v')}))"))
    rows = rows.withColumn("found", F.expr(
        f"transform(found, x -> named_struct('v', x.v, 'kind', x.kind, 'entity', {canonical('x.v', 'x.kind')}))"))
    rows = rows.withColumn("made", F.expr(f"transform(found, x -> if(x.kind is null, null, {core('x.kind', 'x.entity', attempt)}))"))
    new = f"transform(arrays_zip(found, made), y -> if(y.found.kind is null, y.found.v, {dressed('y.found.v', 'y.found.kind', 'y.made')}))"
    rows = rows.withColumn("new", F.expr(new))
    text = (f"if(size(found) > 0, array_join(transform(split(text, {_sql(PATTERN)}, -1), (g, i) ->"
            f" concat(g, coalesce(get(new, i), ''))), ''), text)")
    kinds = "filter(transform(found, x -> x.kind), x -> x is not null)"
    return rows.select("doc_id", F.expr(text).alias("text"), F.expr(f"cast(coalesce(size({kinds}), 0) as int)").alias("n_entities"),
                       F.expr(f"coalesce(array_join({kinds}, ','), '')").alias("kinds"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates(read(spark, sf_dir, "documents"))
