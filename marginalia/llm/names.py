"""Variant spellings of people and organisations: merge-and-rematch resolution.

Records are folded to comparable forms and blocked; matched records are merged, the merged profile holds the union of
their spellings, initials and affiliations and enters blocking again, until a round merges nothing.

People. A profile is an author id with its name forms (surname, given name, middle initials), institutions and ORCIDs.
Two profiles match when they share an institution, their surnames are equal or one edit apart, their given names agree
(equal, one edit apart, nickname, initial), and neither their ORCIDs nor their middle initials contradict each other;
or when they share an ORCID. A profile that is known by initials only is merged with candidates that have a given name
only if all of these agree, and else with those of its own form.
Profiles of equal form are first linked to the smallest id of their class, so pairs are only made between different
forms of neighbouring surnames at one institution.

Organisations. A registered name is a set of elements (kind words in one language, place, topic); a string names the
institution if one of its segments holds all of them. Elements are looked up exactly, then within one edit. Spellings
of matched segments are merged into the vocabulary and unmatched segments are tried again, until nothing is added.

At scale every step is an equi-join or a partial aggregation; profiles hold distinct folded forms, not rows, so an
author with a third of all rows is one profile. Only the list of given names, bounded by GIVEN_SHARE, reaches the driver.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions.ids import canonical_id
from marginalia.sources.tables import cut

#: A word tells the order of names if it stands in at least one of so many two-word names: a share, which also bounds
#: the number of such words that reach the driver, by twice this number.
GIVEN_SHARE = 200_000

# Words of names.
PARTICLES = frozenset("van von der den de la le du di da del dos das el al bin ten ter zu zur".split())
TITLES = frozenset("dr prof professor mr mrs ms sir phd msc md bsc ma ba mba dphil jr sr ii iii iv junior senior".split())
_WORDS = PARTICLES | TITLES
NICKNAMES = {
    "alex": "alexander", "ali": "alice", "andy": "andrew", "annie": "anne", "antonio": "antonio", "tony": "antonio", "toni": "antonio", "becky": "rebecca", "ben": "benjamin", "benny": "benjamin", "beth": "elizabeth",
    "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "charlie": "charles", "chuck": "charles", "chris": "christopher", "dan": "daniel", "danny": "daniel", "dave": "david",
    "dick": "richard", "dora": "theodora", "ed": "edward", "eddie": "edward", "eliza": "elizabeth", "fran": "francisco", "frank": "francisco", "paco": "francisco", "fred": "frederik", "freddy": "frederik", "frederick": "frederik",
    "gabi": "gabriele", "gaby": "gabriele", "greg": "gregory", "isa": "isabella", "bella": "isabella", "jim": "james", "jimmy": "james", "joe": "joseph", "jo": "josephine", "josie": "josephine", "johnny": "john", "jack": "john",
    "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kathrine": "katherine", "larry": "lawrence", "liz": "elizabeth", "lola": "dolores", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "greta": "greta",
    "matt": "matthew", "mike": "michael", "mick": "michael", "mickey": "michael", "nick": "nicholas", "pat": "patricia", "pete": "peter", "rob": "robert", "robbie": "robert", "sam": "samuel", "sammy": "samuel", "steve": "stephen",
    "sue": "susanne", "susi": "susanne", "susan": "susanne", "ted": "theodore", "theo": "theodore", "tom": "thomas", "tommy": "thomas", "ursel": "ursula", "vicky": "victoria", "tori": "victoria", "will": "william", "xenia": "xenia", "joh": "johannes", "hans": "johannes",
}
#: Kind words of organisations in several languages, by element.
KINDS = {
    "university": "university universite universitat universidad universita universiteit universidade univ uni u",
    "hospital": "hospital hopital klinikum klinik hosp",
    "technology": "technology technologie tecnologico tecnologia technische technical tech technol",
    "institute": "institute institut instituto istituto inst hochschule",
    "centre": "centre center ctr centro zentrum cent",
    "research": "research res forschung recherche recherches investigacion",
}
ELEMENT = {word: kind for kind, words in KINDS.items() for word in words.split()}
FILLERS = frozenset("of the de la le du des fur for der die das del and und et y in d l a general generale gen".split())
COUNTRIES = {
    "argentina": "AR", "australia": "AU", "austria": "AT", "belgium": "BE", "brazil": "BR", "canada": "CA", "chile": "CL", "china": "CN", "denmark": "DK", "finland": "FI", "france": "FR", "germany": "DE", "india": "IN", "italy": "IT",
    "japan": "JP", "mexico": "MX", "netherlands": "NL", "norway": "NO", "poland": "PL", "portugal": "PT", "spain": "ES", "sweden": "SE", "switzerland": "CH", "united kingdom": "GB", "united states": "US",
}

_SPECIAL = str.maketrans({"ø": "o", "Ø": "O", "ß": "ss", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ı": "i", "’": "'", "`": "'", "´": "'"})
_DAMAGE = re.compile("[Â-Å][\u0080-¿Œ-Ÿˆ-˜–-™]")


def fold_accents(text: str) -> str:
    """Text without accents and ligatures, UTF-8 that was read as a single-byte code restored; letter case is kept."""
    if _DAMAGE.search(text):
        for code in ("cp1252", "latin-1"):
            try:
                text = text.encode(code).decode("utf-8")
                break
            except UnicodeError:
                continue
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text.translate(_SPECIAL)) if not unicodedata.combining(c))


def _initials(word: str, others_mixed: bool) -> bool:
    return len(word) == 1 or (len(word) <= 3 and word.isupper() and others_mixed)


#: A name in ASCII letters: a word, perhaps an initial, a word.
_PLAIN = re.compile(r"([A-Z][a-z]+) (?:([A-Z])\.? )?([A-Z][a-z]+)")


def parse_name(text: str, given_words: frozenset[str] = frozenset()) -> tuple[str, str, str] | None:
    """(surname, given name or its initial, other initials) of a person's name as typed, folded to lower case.

    Takes "Given Surname", "Surname, Given", "Surname G.M.", "Surname Given" (where given_words tells the order),
    titles, particles and double names. None for a text without a letter.
    """
    plain = _PLAIN.fullmatch(text)
    if plain:  # the usual form, for which what follows comes to the same
        given, middle, surname = plain[1].lower(), (plain[2] or "").lower(), plain[3].lower()
        if not {given, surname} & _WORDS:
            if not middle and surname in given_words and given not in given_words:
                given, surname = surname, given
            return surname, NICKNAMES.get(given, given), middle
    text = re.sub(r"\s+", " ", fold_accents(text)).strip()
    parts = [p.strip() for p in text.split(",") if p.strip()]
    parts = [p for i, p in enumerate(parts) if i == 0 or re.sub(r"[^a-z]", "", p.lower()) not in TITLES]
    mixed = any(c.islower() for c in text)

    def words(part: str) -> list[str]:
        part = re.sub(r"\b([A-Za-z])\.?-[A-Za-z]\b", r"\1", part)  # J.-L. is one initial
        part = re.sub(r"(?<=[A-Za-z])['-](?=[A-Za-z])", "", part)
        found: list[str] = []
        for w in re.findall(r"[A-Za-z0-9]+", part):
            if w.lower() in TITLES and len(w) > 1:
                continue
            found += list(w) if len(w) > 1 and _initials(w, mixed) else [w]
        return found

    if len(parts) > 1:
        surname, given = [w for w in words(parts[0]) if w.lower() not in PARTICLES], words(parts[1])
    else:
        w = words(parts[0]) if parts else []
        if len(w) < 2:
            return (w[0].lower(), "", "") if w else None
        first = next((i for i, x in enumerate(w) if len(x) == 1), None)
        full = [x for x in w if len(x) > 1]
        if len(w[-1]) == 1 and len(full) >= 1 and len(w[0]) > 1:  # Surname G.M.
            surname, given = [x for x in full if x.lower() not in PARTICLES], [x for x in w if len(x) == 1]
        elif first is not None and first > 0:  # Given M. Surname
            last = max(i for i, x in enumerate(w) if len(x) == 1)
            surname, given = w[last + 1 :], w[: last + 1]
        elif first == 0:  # G. M. Surname
            last = next(i for i, x in enumerate(w) if len(x) > 1) if full else len(w)
            surname, given = w[last:], w[:last]
        elif len(w) == 2 and w[1].lower() in given_words and w[0].lower() not in given_words:  # Surname Given
            surname, given = w[:1], w[1:]
        elif len(w) > 2 and w[-1].lower() in given_words and w[0].lower() not in given_words:
            surname, given = w[:-1], w[-1:]
        else:
            surname, given = w[1:], w[:1]
        surname = [x for x in surname if x.lower() not in PARTICLES] or surname
    key = "".join(surname).lower()
    names = [x.lower() for x in given if x.lower() not in PARTICLES]
    if not key:
        return None
    head = names[0] if names else ""
    return key, NICKNAMES.get(head, head), "".join(sorted({x[0] for x in names[1:]}))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two words are equal, one edit or one swap of neighbours apart."""
    at = F.length(F.regexp_extract(F.concat(a, F.lit("\u0000"), b), "^([^\u0000]*)[^\u0000]*\u0000\\1", 1))
    distance = F.levenshtein(a, b, 2)  # -1 beyond 2
    swapped = (F.length(a) == F.length(b)) & (distance == 2) & (F.concat(F.substr(a, F.lit(1), at), F.substr(a, at + 2, F.lit(1)), F.substr(a, at + 1, F.lit(1)), F.substr(a, at + 3)) == b)
    return (a == b) | distance.isin(0, 1) | swapped


def _dropped(words: DataFrame, least: int) -> DataFrame:
    """(word, cut) of the words of at least `least` letters: the word, and the word without each of its letters.

    Two words one edit or swap apart share a cut. Of equal letters in a row only the first is dropped.
    """
    word, at = F.col("word"), F.col("at")
    spread = words.where(F.length("word") >= least).select("word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    spread = spread.where((at < 2) | (F.substr(word, at, F.lit(1)) != F.substr(word, at - 1, F.lit(1))))
    return spread.select("word", F.when(at == 0, word).otherwise(F.concat(F.substr(word, F.lit(1), at - 1), F.substr(word, at + 1))).alias("cut"))


def neighbours(words: DataFrame, known: DataFrame, least: int) -> DataFrame:
    """(word, near) with `near` of `known.word` one edit from `word`; both of at least `least` letters, not equal."""
    near = _dropped(known, least).withColumnRenamed("word", "near")
    return _dropped(words, least).join(near, "cut").where((F.col("word") != F.col("near")) & one_edit(F.col("word"), F.col("near"))).select("word", "near").distinct()


def neighbours_within(words: DataFrame, least: int) -> DataFrame:
    """`neighbours` of the words among themselves: each pair is compared in one direction and given in both."""
    spread = _dropped(words, least)
    pairs = spread.join(spread.select(F.col("word").alias("near"), "cut"), "cut").where(F.col("word") < F.col("near")).select("word", "near").distinct().where(one_edit(F.col("word"), F.col("near")))
    both = F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"))))
    return pairs.select(both.alias("p")).select("p.*")


# ---- organisations ----


def _tokens(text: str) -> list[str]:
    text = re.sub(r"\S+@\S+", " ", fold_accents(text))
    text = re.sub(r"\b\d+\s+\w+\s+(?:street|st|road|avenue|strasse|rue)\b", " ", text, flags=re.I)
    text = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", text)
    return re.findall(r"[a-z0-9]+", text.lower())


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("country", T.StringType())])))
def _segments(texts: pd.Series) -> pd.Series:
    def of(text: str) -> list[dict]:
        found = []
        for part in re.split(r"[;|\n]", text or ""):
            words = _tokens(part)
            plain = " ".join(words)
            code = next((c for name, c in COUNTRIES.items() if re.search(rf"\b{name}\b", plain)), None) or next(iter(re.findall(r"\(([A-Z]{2})\)", part)), None)
            if words:
                found.append({"words": sorted(set(words)), "country": code})
        return found

    return texts.map(of)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _name_elements(names: pd.Series, places: pd.Series) -> pd.Series:
    def of(name: str | None, place: str | None) -> list[str]:
        at = "".join(_tokens(place or "")[:1])
        words = [w for w in _tokens(name or "") if w not in FILLERS]
        return sorted({at if at and w in (at, at + "er") else ELEMENT.get(w, w) for w in words})

    return pd.Series([of(n, p) for n, p in zip(names, places, strict=True)])


def registry(institutions: DataFrame) -> DataFrame:
    """(institution_id, country, elements, anchor): the ways a registered institution is named.

    `anchor` is the rarest element of the registered names, the key of the block. Names that fold to nothing are left out.
    """
    base = institutions.select(canonical_id(F.col("institution_id")).alias("institution_id"), F.col("country_code").alias("country"), _name_elements("display_name", "city").alias("named"), _name_elements("acronym", F.lit(None).cast("string")).alias("short"))
    ways = base.select("institution_id", "country", F.explode(F.array(F.struct(F.col("named").alias("elements"), F.lit(False).alias("acronym")), F.struct(F.transform("short", lambda w: F.concat(F.lit("="), w)).alias("elements"), F.lit(True).alias("acronym")))).alias("w"))
    ways = ways.select("institution_id", "country", "w.elements").where((F.col("institution_id").isNotNull()) & (F.size("elements") > 0)).distinct()
    spread = ways.select("institution_id", "country", "elements", F.explode("elements").alias("element"))
    rarity = spread.groupBy("element").agg(F.count(F.lit(1)).alias("uses"))
    kind = F.col("element").isin(*KINDS)
    best = F.min_by("element", F.struct(kind, "uses", "element"))
    return spread.join(rarity, "element").groupBy("institution_id", "country", "elements").agg(best.alias("anchor"))


def link_organisations(mentions: DataFrame, institutions: DataFrame) -> DataFrame:
    """The columns of `mentions` but text, and institution_id: the registered institutions that strings of a mention name.

    `mentions`: text and columns that tell the mention; a column institution_id is replaced. Null and empty texts name nothing; repeated rows change nothing; a text may name
    several. Of places one edit away from the text, those spelled exactly win, then those of the country that the text
    names; a text whose misspelt place fits several institutions still names none of them. An empty registry or empty
    mentions give no row.
    """
    ways = cut(registry(institutions))
    texts = mentions.where(F.col("text") != "").select("text").distinct()
    segments = texts.select("text", F.posexplode(_segments("text")).alias("at", "s")).select("text", "at", "s.words", "s.country")
    segments = cut(segments.withColumn("segment", F.xxhash64("text", "at")))
    elements = ways.select(F.explode("elements").alias("element")).distinct()
    acronym = F.col("element").startswith("=")
    exact = elements.select(F.explode(F.when(acronym, F.array(F.expr("substring(element, 2)"))).otherwise(F.array(F.col("element"), F.concat("element", F.lit("er"))))).alias("word"), "element")
    exact = exact.unionByName(ways.sparkSession.createDataFrame(sorted(ELEMENT.items()), "word string, element string")).distinct()
    # what was learned last, at first all; acronyms have no misspellings
    learned = exact.withColumn("plain", ~acronym)
    known = learned.where("plain").select("word").distinct()
    found: DataFrame | None = None
    looked: DataFrame | None = None
    rest = segments
    while True:
        words = rest.select(F.explode("words").alias("word")).distinct()
        plain = learned.where("plain").select(F.col("word").alias("near"), "element")
        near = neighbours(words.join(known, "word", "left_anti"), plain.select(F.col("near").alias("word")).distinct(), 4)
        told = words.join(learned, "word").select("word", "element", F.lit(0).alias("edits")).unionByName(near.join(plain, "near").select("word", "element", F.lit(1).alias("edits")))
        if looked is not None:
            # only segments with a word that is read anew can name something now
            told = cut(told)
            anew = rest.select("segment", F.explode("words").alias("word")).join(told.select("word").distinct(), "word", "left_semi").select("segment").distinct()
            told, asked = told.unionByName(looked), rest.join(anew, "segment", "left_semi")
        else:
            asked = rest
        looked = cut(told.groupBy("word", "element").agg(F.min("edits").alias("edits")))
        held = asked.select("segment", "country", F.explode("words").alias("word")).join(looked, "word").groupBy("segment", "country", "element").agg(F.min("edits").alias("edits"), F.min_by("word", "edits").alias("word"))
        sets = held.groupBy("segment").agg(F.collect_set("element").alias("has"))
        anchored = held.join(ways.withColumnRenamed("country", "home"), held["element"] == ways["anchor"]).join(sets, "segment").where(F.size(F.array_except("elements", "has")) == 0)
        per = Window.partitionBy("segment")
        abroad = F.when(F.col("country").isNull() | F.col("home").isNull() | (F.col("edits") == 0), 0).otherwise(F.when(F.col("country") == F.col("home"), 0).otherwise(1))
        ranked = anchored.withColumn("rank", F.struct(F.col("edits"), abroad.alias("abroad"))).withColumn("best", F.min("rank").over(per)).where(F.col("rank") == F.col("best"))
        # one misspelt word that fits two places
        single = ranked.withColumn("fits", F.size(F.collect_set("anchor").over(Window.partitionBy("segment", "word")))).where((F.col("edits") == 0) | (F.col("fits") == 1))
        new = cut(single.select("segment", "institution_id", "word", "anchor", "edits").distinct())
        found = new if found is None else found.unionByName(new)
        # spellings of merged segments, where the misspelt word is near one element only
        alone = looked.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 1).select("word")
        learned = cut(new.where(F.col("edits") > 0).select("word", F.col("anchor").alias("element")).distinct().join(alone, "word", "left_semi").withColumn("plain", F.lit(True)))
        if learned.isEmpty():
            break
        known, rest = known.unionByName(learned.select("word")), cut(rest.join(new.select("segment"), "segment", "left_anti"))
    named = found.join(segments.select("segment", "text"), "segment").select("text", "institution_id").distinct()
    return mentions.drop("institution_id").join(named, "text").drop("text").distinct()


# ---- people ----

_FORM = T.StructType([T.StructField(n, T.StringType()) for n in ("surname", "given")])
_STRINGS = T.ArrayType(T.StringType())
#: Pairs of neighbouring surnames up to which they travel by broadcast; beyond, both sides are shuffled.
NEAR_PAIRS = 200_000


def _given_words(spellings: DataFrame) -> frozenset[str]:
    """The words that stand first in two-word names much more often than last; see GIVEN_SHARE."""
    words = F.split(F.lower(F.trim("spelling")), r"\s+")
    # exploded, so that names are split once, not for each use
    plain = spellings.select(F.explode(F.array(words)).alias("w")).where((F.size("w") == 2) & ~F.col("w")[0].contains(",") & (F.length(F.col("w")[0]) > 2) & (F.length(F.col("w")[1]) > 2))
    ends = plain.select(F.explode(F.array(F.struct(F.col("w")[0].alias("word"), F.lit(1).alias("first")), F.struct(F.col("w")[1].alias("word"), F.lit(0).alias("first")))).alias("e")).select("e.*")
    counts = ends.groupBy("word").agg(F.sum("first").alias("first"), F.count(F.lit(1)).alias("n"))
    # three of four, with one name more that says the opposite
    ends_all = F.broadcast(counts.agg(F.sum("n").alias("ends")))  # two a name
    told = counts.where(F.col("first") * 4 >= (F.col("n") + 1) * 3).join(ends_all, F.col("n") * 2 * GIVEN_SHARE >= F.col("ends")).select("word")
    return frozenset(re.sub("['-]", "", fold_accents(r["word"])).lower() for r in told.collect())


def edited(a: str, b: str) -> bool:
    """Whether two words are equal, one edit or one swap of neighbours apart."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i + 1 : i + 2] == b[i] and b[i + 1 : i + 2] == a[i] and a[i + 2 :] == b[i + 2 :])
    return a[i:] == b[i + 1 :]


def leading_forms(parsed: list[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """The forms (surname, given) that a person enters blocks with, of one parsed name per spelling.

    Left out are initials where the surname stands with a given name of that initial, and forms one edit from a form
    that more spellings of the person have: they are found through that one.
    """
    counts: dict[tuple[str, str], int] = {}
    for surname, given, _ in parsed:
        counts[surname, given] = counts.get((surname, given), 0) + 1
    if len(counts) == 1:
        return list(counts)
    full = {(s, g[0]) for s, g in counts if len(g) > 1}
    kept = [f for f in counts if len(f[1]) > 1 or (f[0], f[1][:1]) not in full]

    def slip(f: tuple[str, str], of: tuple[str, str]) -> bool:
        alike = f[1][:1] == of[1][:1] if min(len(f[1]), len(of[1])) <= 1 else edited(f[1], of[1])
        return counts[f] < counts[of] and edited(f[0], of[0]) and min(len(f[0]), len(of[0])) >= 5 and alike and (len(of[1]) > 1 or len(f[1]) <= 1)

    return sorted(f for f in kept if not any(slip(f, of) for of in kept if of != f))


def profiles(records: DataFrame) -> DataFrame:
    """(person, forms, givens, middles, places, orcids): what is known of each person, as distinct folded values.

    `records`: person, spellings and places (arrays), orcid; nulls and empty strings in any of them are passed over.
    Persons with neither a name nor an ORCID are left out.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("values")) for k, v in (("s", F.col("spellings")), ("p", F.col("places")), ("o", F.array("orcid")))])).alias("k")
    every = records.select("person", kinds).select("person", "k.kind", F.explode("k.values").alias("value"))
    # distinct before they are gathered by person, so that a person with many rows is gathered by its few values
    values = cut(every.distinct().where((F.col("person") != "") & (F.col("value") != "")))
    words = _given_words(values.where("kind = 's'").select(F.col("value").alias("spelling")))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        """Of (person, forms, givens, middles, places, orcids); forms are pairs."""
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(6)]
        offsets = pa.array(np.cumsum([0, *map(len, columns[1])]), pa.int32())
        pairs = [pa.array([f[i] for forms in columns[1] for f in forms], pa.string()) for i in (0, 1)]
        forms = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(pairs, ["surname", "given"]))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), forms, *[pa.array(c, pa.list_(pa.string())) for c in columns[2:]]], names=["person", "forms", "givens", "middles", "places", "orcids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = lru_cache(100_000)(lambda s: parse_name(s, words))
        rows: list[tuple] = []
        person: str | None = None
        held: dict[str, list[str]] = {"s": [], "p": [], "o": []}

        def close() -> None:
            parsed = [p for p in map(parse, held["s"]) if p]
            if parsed or held["o"]:
                rows.append((person, leading_forms(parsed), sorted({p[1] for p in parsed if len(p[1]) > 1}), sorted({c for p in parsed for c in p[2]}), held["p"], held["o"]))

        for b in batches:
            for who, kind, value in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if who != person:
                    if person is not None:
                        close()
                    person, held = who, {"s": [], "p": [], "o": []}
                held[kind].append(value)
            if len(rows) >= 5_000:
                yield batch(rows)
                rows.clear()
        if person is not None:
            close()
        yield batch(rows)

    schema = T.StructType([T.StructField("person", T.StringType()), T.StructField("forms", T.ArrayType(_FORM)), *[T.StructField(n, _STRINGS) for n in ("givens", "middles", "places", "orcids")]])
    return values.repartition("person").sortWithinPartitions("person", "kind", "value").mapInArrow(run, schema)


def _placed(people: DataFrame) -> DataFrame:
    """One row for each form and place of a person, with fingerprints of what tells classes of equal form apart."""
    known = people.select("person", "forms", "places", F.xxhash64("middles", "orcids").alias("sign"), F.xxhash64("givens").alias("named"), (F.size("givens") == 0).alias("poor"))
    return known.select("person", "sign", "named", "poor", "places", F.inline("forms")).select("person", "surname", "given", F.explode("places").alias("place"), "sign", "named", "poor")


def _alike(x: Column, y: Column) -> Column:
    return (x == y) | ((F.least(F.length(x), F.length(y)) >= 4) & one_edit(x, y))


def _agreed(edges: DataFrame) -> DataFrame:
    """Of (w1, w2, twin), distinct profiles w1 < w2 that met in a block, twins in the same class, the pairs (a, b) to merge, a < b."""
    one, two = F.col("w1"), F.col("w2")

    def clash(name: str) -> Column:
        return (F.size(one[name]) > 0) & (F.size(two[name]) > 0) & ~F.arrays_overlap(one[name], two[name])

    full_1, full_2 = F.size(one["givens"]) > 0, F.size(two["givens"]) > 0
    same_orcid = F.arrays_overlap(one["orcids"], two["orcids"])
    agree = F.exists(one["givens"], lambda x: F.exists(two["givens"], lambda y: _alike(x, y)))
    kept = edges.where(same_orcid | (~clash("orcids") & ~clash("middles") & (~(full_1 & full_2) | agree)))
    strong = same_orcid | (full_1 & full_2)
    flat = kept.select(one["person"].alias("a"), two["person"].alias("b"), "twin", strong.alias("strong"), (full_1 | full_2).alias("named"), F.when(full_1, two["person"]).otherwise(one["person"]).alias("poor"), F.when(full_1, one["person"]).otherwise(two["person"]).alias("rich"), F.when(full_1, one["givens"]).otherwise(two["givens"]).alias("givens"))
    flat = cut(flat)
    # a profile known by initials only: merged with candidates that have a given name if all of these share one
    weak = flat.where(~F.col("strong") & F.col("named")).select("poor", "rich", F.explode("givens").alias("given")).repartition("poor").distinct()
    votes = weak.groupBy("poor", "given").agg(F.count(F.lit(1)).alias("n")).groupBy("poor").agg(F.max("n").alias("agreed"))
    decided = cut(votes.join(weak.groupBy("poor").agg(F.count_distinct("rich").alias("riches")), "poor").select("poor", (F.col("agreed") == F.col("riches")).alias("sure")))
    by_name = flat.where(~F.col("strong") & F.col("named")).join(decided.where("sure"), "poor", "left_semi")
    # two such profiles: one that is sure of a name is merged with that first and met again; else twins are one, and others if no name is in sight
    state = lambda side: decided.select(F.col("poor").alias(side), F.col("sure").alias(f"sure_{side}"))
    blank = flat.where(~F.col("strong") & ~F.col("named")).select("a", "b", "twin").distinct().join(state("a"), "a", "left").join(state("b"), "b", "left")
    nameless = F.col("sure_a").isNull() & F.col("sure_b").isNull()
    unsure = ~F.coalesce("sure_a", F.lit(False)) & ~F.coalesce("sure_b", F.lit(False))
    blank = blank.where(nameless | (F.col("twin") & unsure))
    return flat.where("strong").select("a", "b").unionByName(by_name.select("a", "b")).unionByName(blank.select("a", "b"))


def _moved(placed: DataFrame, near: DataFrame) -> DataFrame:
    """Forms under the surnames near their own."""
    return placed.join(near, F.col("surname") == F.col("word")).select("person", F.col("near").alias("surname"), "given", "place")


def _meet(fresh: DataFrame, heads: DataFrame, once: bool = False) -> DataFrame:
    """(p1, p2) of fresh forms and known heads of one surname at one place whose given names may be one; `once`: p1 < p2."""
    block = F.xxhash64("surname", "place").alias("block")
    asked = fresh.select(block, F.col("given").alias("g1"), F.col("person").alias("p1"))
    pairs = asked.join(heads.select(block, F.col("given").alias("g2"), F.col("person").alias("p2")), "block").where(F.col("p1") < F.col("p2") if once else F.col("p1") != F.col("p2"))
    g1, g2 = F.col("g1"), F.col("g2")
    initial = (F.length(g1) <= 1) | (F.length(g2) <= 1)
    return pairs.where(F.when(initial, F.substring(g1, 1, 1) == F.substring(g2, 1, 1)).otherwise(_alike(g1, g2))).select("p1", "p2")


def components(edges: DataFrame) -> DataFrame:
    """(person, entity) of (a, b): entity is the smallest person that a chain of edges reaches, and itself no row.

    `edges` is read in each round, so it should come from `cut`, as the result does.
    """
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    labels = cut(both.groupBy(F.col("a").alias("person")).agg(F.least(F.min("b"), F.col("person")).alias("entity")))
    while True:
        heard = both.join(labels.select(F.col("person").alias("b"), "entity"), "b").groupBy(F.col("a").alias("person")).agg(F.min("entity").alias("heard"))
        step = labels.join(heard, "person").select("person", F.col("entity").alias("was"), F.least("entity", "heard").alias("entity"))
        jump = step.join(labels.select(F.col("person").alias("entity"), F.col("entity").alias("far")), "entity", "left").select("person", "was", F.least("entity", F.coalesce("far", "entity")).alias("entity"))
        jump = cut(jump)
        labels = jump.select("person", "entity")
        if jump.where(F.col("was") != F.col("entity")).isEmpty():
            return labels.where(F.col("person") != F.col("entity"))


def _matched(placed: DataFrame, near: DataFrame, people: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b, repeated: profiles to merge, of rows of `_placed` of `people`. With `fresh` (person) only what these can change.

    That is the pairs with one of them, and all pairs of those initials-only profiles that meet one of them, as such a
    profile is decided over all its candidates.
    """
    first = fresh is None
    if first:
        placed = placed.withColumn("fresh", F.lit(True))
    else:
        under = lambda rows: rows.select("surname", "given", "place").unionByName(_moved(rows, near).select("surname", "given", "place"))
        initial = F.substring("given", 1, 1).alias("initial")
        met = under(placed.join(fresh, "person", "left_semi")).select("surname", "place", initial).distinct()
        poor = placed.where("poor").withColumn("initial", initial).join(met, ["surname", "place", "initial"], "left_semi").select("person")
        fresh = cut(fresh.unionByName(poor).distinct())
        blocks = under(placed.join(fresh, "person", "left_semi")).select("surname", "place").distinct()
        placed = placed.join(blocks, ["surname", "place"], "left_semi").join(fresh.withColumn("fresh", F.lit(True)), "person", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    # equal forms at one place: the class is linked to its smallest member, which speaks for it; where only the initial
    # is equal, given names tell classes apart, and members known by initials only are decided each for itself
    classes = Window.partitionBy("surname", "place", F.xxhash64("given", "sign", F.when(F.length("given") <= 1, F.col("named"))))
    placed = cut(placed.select("person", "surname", "given", "place", "poor", F.min("person").over(classes).alias("head"), F.max("fresh").over(classes).alias("fresh")))
    is_head = F.col("person") == F.col("head")
    starred = placed.where("fresh").where(~is_head).select(F.col("head").alias("p1"), F.col("person").alias("p2"), F.lit(True).alias("twin"))
    heads = placed.where(is_head)
    asked, members = heads.where("fresh"), placed.where(F.col("fresh") & ~is_head & F.col("poor"))
    if first:
        # each pair of equal surnames, and each pair of near ones, is met once
        met = _meet(asked, heads, once=True).unionByName(_meet(_moved(asked, near.where(F.col("word") < F.col("near"))), heads))
    else:
        met = _meet(asked, heads).unionByName(_meet(_moved(asked, near), heads))
    rest = _meet(members, heads).unionByName(_meet(_moved(members, near), heads))
    edges = met.unionByName(rest).withColumn("twin", F.lit(False)).unionByName(starred).select(F.least("p1", "p2").alias("p1"), F.greatest("p1", "p2").alias("p2"), "twin").distinct()
    who = lambda side: people.select(F.col("person").alias(f"p{side}"), F.struct("person", "givens", "middles", "orcids").alias(f"w{side}"))
    return _agreed(edges.join(who(1), "p1").join(who(2), "p2").select("w1", "w2", "twin"))


def _clashing(sets: Column) -> Column:
    """Whether two of the sets hold something and nothing in common."""
    return F.exists(sets, lambda x: (F.size(x) > 0) & F.exists(sets, lambda y: (F.size(y) > 0) & ~F.arrays_overlap(x, y)))


def merge_agreeing(members: dict[str, dict], edges: list[tuple[str, str]]) -> dict[str, str]:
    """Person to entity: edges are followed from the surest on, unless the profiles merged so far contradict each other.

    Surest are a common ORCID, then given names on both sides with common middle initials, then given names on both
    sides, then the rest; of equal ones those with more common places, then the smaller ids.
    """
    profile = {p: {c: set(m[c]) for c in ("givens", "middles", "places", "orcids")} for p, m in members.items()}
    root = {p: p for p in members}

    def find(p: str) -> str:
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    def order(edge: tuple[str, str]) -> tuple:
        x, y = profile[edge[0]], profile[edge[1]]
        full = bool(x["givens"] and y["givens"])
        kind = 0 if x["orcids"] & y["orcids"] else 1 if full and x["middles"] & y["middles"] else 2 if full else 3
        return kind, -len(x["places"] & y["places"]), *edge

    for a, b in [e for _, e in sorted((order(e), e) for e in edges)]:
        a, b = sorted((find(a), find(b)))
        x, y = profile[a], profile[b]
        clash = any(x[c] and y[c] and not x[c] & y[c] for c in ("orcids", "middles"))
        if a != b and (x["orcids"] & y["orcids"] or not clash):
            root[b] = a
            for c in x:
                x[c] |= y[c]
    return {p: find(p) for p in members}


def _settled(edges: DataFrame, current: DataFrame) -> DataFrame:
    """(person, entity) of the profiles that the edges merge, without merging profiles that contradict each other.

    Two profiles that agree may each agree with a third one and contradict each other through it; chains that hold such
    profiles are followed edge by edge, each chain in one task.
    """
    entity = components(edges)
    named = entity.unionByName(entity.select(F.col("entity").alias("person"), "entity").distinct())
    known = named.join(current, "person")
    doubtful = cut(known.groupBy("entity").agg(F.collect_set("middles").alias("m"), F.collect_set("orcids").alias("o")).where(_clashing(F.col("m")) | _clashing(F.col("o"))).select("entity"))
    if doubtful.isEmpty():
        return entity
    none = F.lit(None).cast("string")
    rows = known.join(doubtful, "entity", "left_semi").select("entity", "person", none.alias("other"), "givens", "middles", "places", "orcids")
    links = edges.join(named.withColumnRenamed("person", "a"), "a").join(doubtful, "entity", "left_semi").select("entity", F.col("a").alias("person"), F.col("b").alias("other"), *[F.lit(None).cast("array<string>").alias(c) for c in ("givens", "middles", "places", "orcids")])

    def solve(chain: pd.DataFrame) -> pd.DataFrame:
        own = chain["other"].isna()
        found = merge_agreeing(chain[own].set_index("person").to_dict("index"), list(zip(chain["person"][~own], chain["other"][~own], strict=True)))
        return pd.DataFrame([(p, e) for p, e in found.items() if p != e], columns=["person", "entity"])

    return entity.join(doubtful, "entity", "left_anti").unionByName(rows.unionByName(links).groupBy("entity").applyInPandas(solve, "person string, entity string"))


def resolve_people(records: DataFrame) -> DataFrame:
    """(person, entity): the entity of every person that was merged with another one; entity is its smallest person.

    `records`: person, spellings and places (arrays of strings), orcid; one row as delivered, repeated rows change
    nothing, nulls and empty strings are passed over. Persons that match nobody have no row, nor has an empty table.
    A profile that agrees with several which contradict each other is merged with one of them, see `merge_agreeing`.
    """
    people = cut(profiles(records))
    placed = _placed(people)
    surnames = people.where(F.size("places") > 0).select(F.explode("forms.surname").alias("word")).distinct()
    near = cut(neighbours_within(surnames, 5))
    if near.count() <= NEAR_PAIRS:
        near = F.broadcast(near)
    by_orcid = people.select("person", F.explode("orcids").alias("orcid")).withColumn("a", F.min("person").over(Window.partitionBy("orcid"))).where(F.col("person") != F.col("a")).select("a", F.col("person").alias("b"))
    new = cut(_matched(placed, near, people).unionByName(by_orcid).distinct())
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    labels = merged = None
    current = people
    while not new.isEmpty():
        # merged profiles stand for their members with the union of what is known of them; those that grew are matched
        # again, with whatever stands in their blocks by now
        step = cut(_settled(new, current))
        named = step.unionByName(step.select(F.col("entity").alias("person"), "entity").distinct())
        grown = named.join(current, "person").groupBy("entity").agg(*[union(c) for c in ("forms", "givens", "middles", "places", "orcids")]).withColumnRenamed("entity", "person")
        if labels is None:
            labels, merged = step, cut(grown)
        else:
            further = step.select(F.col("person").alias("entity"), F.col("entity").alias("to"))
            labels = cut(labels.join(further, "entity", "left").select("person", F.coalesce("to", "entity").alias("entity")).unionByName(step))
            merged = cut(merged.join(named, "person", "left_anti").unionByName(grown))
        gone = labels.select("person").unionByName(labels.select(F.col("entity").alias("person")))
        current = cut(people.join(gone, "person", "left_anti").unionByName(merged))
        new = cut(_matched(_placed(current), near, current, step.select(F.col("entity").alias("person")).distinct()).distinct())
    return labels if labels is not None else people.sparkSession.createDataFrame([], "person string, entity string")


def entity_pairs(entity: DataFrame) -> DataFrame:
    """(key_1, key_2): all pairs of persons of one entity, the smaller first."""
    members = entity.select("entity", "person").unionByName(entity.select("entity", F.col("entity").alias("person"))).distinct()
    return members.join(members.select("entity", F.col("person").alias("other")), "entity").where(F.col("person") < F.col("other")).select(F.col("person").alias("key_1"), F.col("other").alias("key_2")).distinct()
