"""Personal data replaced by keyed surrogates of the same type and form.

Entities are found by patterns, and names by titles and lists of given names. What is
replaced is a value: an address, a number without its separators, a given name, a family
name. Each distinct value of the corpus gets one surrogate, made from a keyed hash, so all
mentions of a value change alike in whatever format they are written, and "Frau Adler"
stays the same person as "Eva Adler". Surrogates keep length and separators of numbers,
country codes, shape of addresses, gender and script of given names.

Distinctness is checked over the whole table of values: a surrogate that two values share,
or that is itself a value of the corpus, is drawn anew with the next attempt's hash until
none is left; a form with too few free surrogates is made wider. Values and mentions only
meet in joins and aggregates; a text is moved only if it has entities, and no Python runs on
the rows.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.workspace import Workspace

# Common given names by gender and script.
GIVEN = {
    ("f", "latin"): "Alice Anna Brigitte Carmen Charlotte Claire Clara Elena Emily Emma Eva Hannah "
    "Isabel Jane Julia Laura Lucy Marie Martina Mary Olivia Paula Petra Sarah Sofia Susan".split(),
    ("m", "latin"): "Alexander Antonio Carlos Charles David Felix Georg Hans Henri Jack Jacques James "
    "John Juan Klaus Lukas Manuel Michael Miguel Oliver Paul Peter Pierre Robert Thomas William".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Софья Татьяна".split(),
    ("m", "cyrillic"): "Алексей Андрей Борис Дмитрий Иван Михаил Николай Павел Пётр Сергей".split(),
}
# Titles that a name follows.
TITLES = ("Mr\\.", "Mrs\\.", "Ms\\.", "Dr\\.", "Prof\\.", "Herr", "Frau", "Mme", "Sr\\.", "Sra\\.", "г-н", "г-жа")
# Syllables that family names are made of, by script; 32 each.
SYLLABLES = {
    "latin": "bar bel ber cor dal den dor fal fen gar gel hal hen kel lan lar len lin mar men "
    "mor nal nor pal ran rel ros sal sen tal tor ven".split(),
    "cyrillic": "бар бел бер вал вер гор дан дол ер жар зан зор ил кал кор лан лев лис мар мол "
    "нов ор пал пет рас рог сав сен тар тол ур чер".split(),
}

_WORD = r"\p{L}\p{N}"
_CAPITAL = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# What a name or title starts with; spares a regex all the lists at most places.
_INITIAL = "[A-Z\u0410-\u042f\u0433]"
_ALL_GIVEN = "|".join(sorted({n for names in GIVEN.values() for n in names}))

# Digits of the shortest international numbers, country code included.
PHONE_LEAST = 7
# Written out, as lookbehind takes no repeated group.
_ENOUGH = r"[ .-]?\(?\d\)?" * PHONE_LEAST

# Patterns by type, in the order in which they are tried at a place.
PATTERNS = {
    "email": rf"(?<![{_WORD}._%+-])[{_WORD}._%+-]{{1,64}}+@(?:[A-Za-z0-9-]{{1,63}}\.){{1,8}}[A-Za-z]{{2,24}}",
    "iban": rf"(?<![{_WORD}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,4}})?(?![{_WORD}])",
    "card": rf"(?<![{_WORD}.+-])(?:\d{{4}}[ -]?\d{{4}}[ -]?\d{{4}}[ -]?\d{{4}}|3[47]\d{{2}}[ -]?\d{{6}}[ -]?\d{{5}})(?![{_WORD}])",
    "phone": rf"(?<![{_WORD}.+])(?:\+1[ .-]?(?:\(\d{{3}}\)|\d{{3}})[ .-]?\d{{3}}[ .-]?\d{{4}}|\+(?!1[ .(-])\d{{1,3}}(?:[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})){{2,5}}(?<={_ENOUGH})|\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}})(?![{_WORD}])",
    "ssn": rf"(?<![{_WORD}-])\d{{3}}-\d{{2}}-\d{{4}}(?![{_WORD}-])",
    "ip": rf"(?<![{_WORD}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![{_WORD}]|\.\d)",
    "person": rf"(?={_INITIAL})(?<!\p{{L}})(?:(?:{'|'.join(TITLES)}) (?:(?:{_ALL_GIVEN}) )?{_CAPITAL}|(?:{_ALL_GIVEN}) {_CAPITAL})(?!\p{{L}})",
}
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())

# A text without any of these signs has no entity.
SIGN = rf"[0-9@]|(?={_INITIAL})(?<!\p{{L}})(?:{'|'.join(TITLES)}|{_ALL_GIVEN}) "

# How often a number's surrogate is drawn in the number's own form; each later draw has one
# digit more, so that there is room for any number of values.
ATTEMPTS = 20


# --- mentions ------------------------------------------------------------------------


def _kind(mention: Column) -> Column:
    """Which pattern a mention is of; a mention is what one of them matched whole."""
    chosen = F.lit("person")
    for kind in reversed([k for k in PATTERNS if k != "person"]):
        # The places next to a mention have been looked at already.
        inner = PATTERNS[kind]
        chosen = F.when(mention.rlike(f"^(?:{inner})$"), F.lit(kind)).otherwise(chosen)
    return chosen


def _gender(given: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for (gender, script), names in GIVEN.items():
        chosen = F.when(given.isin(names), F.lit(f"given {gender} {script}")).otherwise(chosen)
    return chosen


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "family cyrillic").otherwise("family latin")


def _parts(mention: Column) -> Column:
    """A mention as parts (kind, text): values to replace, and text to keep (kind null)."""

    def part(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), text.alias("text"))

    kind = _kind(mention)
    keep = F.lit(None).cast("string")
    words = F.split(mention, " ")
    names = F.transform(
        words,
        lambda word, at: part(
            F.when(at == F.size(words) - 1, _script(word)).otherwise(_gender(word)),
            F.when(at == 0, word).otherwise(F.concat(F.lit(" "), word)),
        ),
    )
    # The blank before a name is kept apart from the name.
    spaced = F.flatten(
        F.transform(
            names,
            lambda p: F.array(
                part(keep, F.when(p["text"].startswith(" "), " ").otherwise("")),
                part(p["kind"], F.ltrim(p["text"])),
            ),
        )
    )
    return F.when(kind == "person", spaced).otherwise(F.array(part(kind, mention)))


def _value(kind: Column, text: Column) -> Column:
    """What mentions of one thing have in common."""
    return (
        F.when(kind == "email", F.lower(text))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(text, r"[ ().-]", ""))
        .when(kind == "iban", F.replace(text, F.lit(" "), F.lit("")))
        .otherwise(text)
    )


# --- surrogates ----------------------------------------------------------------------


def _drawn(digest: Column, at: Column, among: int) -> Column:
    """A number below ``among`` from two bytes of a hex digest of 64 bytes."""
    two = F.substring(digest, (at % 32) * 4 + 1, F.lit(4))
    return F.conv(two, 16, 10).cast("int") % among


def _redrawn(text: Column, digest: Column, kept: Column) -> Column:
    """Digits and ASCII letters after the first ``kept`` characters drawn anew."""

    def one(char: Column, at: Column) -> Column:
        low, high = (
            F.substring(F.lit(letters), _drawn(digest, at, 26) + 1, F.lit(1))
            for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        )
        return (
            F.when(at < kept, char)
            .when(char.rlike("[0-9]"), _drawn(digest, at, 10).cast("string"))
            .when(char.rlike(r"\p{Ll}"), low)
            .when(char.rlike(r"\p{Lu}"), high)
            .otherwise(char)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _picked(names: list[str], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), _drawn(digest, F.lit(at), len(names)) + 1)


def _surrogate(kind: Column, value: Column, digest: Column, attempt: int) -> Column:
    """A value of the same type; later attempts have more room where the form allows it."""
    none = F.lit(0)
    local, domain = (F.substring_index(value, "@", side) for side in (1, -1))
    ending = F.substring_index(domain, ".", -1)
    site = _redrawn(F.lit("aaaaaa" + "a" * attempt), digest, none)
    email = F.concat(
        _redrawn(local, F.reverse(digest), none), F.lit("@"), site, F.lit(".example."), ending
    )
    wider = max(0, attempt - ATTEMPTS + 1)
    octets = [(_drawn(digest, F.lit(i), 254) + 1).cast("string") for i in range(4 + wider)]
    number = F.concat(value, F.lit("0" * wider))
    chosen = (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "iban", _redrawn(number, digest, F.lit(2)))
        .when(kind == "card", _redrawn(number, digest, F.lit(1)))
        .when(
            (kind == "phone") & value.startswith("+"),
            # The sign and the country code stay: one digit for zones 1 and 7.
            _redrawn(number, digest, F.when(value.rlike("^[+][17]"), 2).otherwise(3)),
        )
        .otherwise(_redrawn(number, digest, none))
    )
    for (gender, script), names in GIVEN.items():
        # A list is small; from the second attempt on, names are double ones.
        name = _picked(names, digest, 0)
        for more in range(attempt):
            name = F.concat(name, F.lit("-"), _picked(names, digest, more + 1))
        chosen = F.when(kind == f"given {gender} {script}", name).otherwise(chosen)
    for script, syllables in SYLLABLES.items():
        name = F.initcap(F.concat(*[_picked(syllables, digest, i) for i in range(4 + attempt)]))
        chosen = F.when(kind == f"family {script}", name).otherwise(chosen)
    return chosen


def surrogates(work: Workspace, values: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate``: one for each distinct value, no two alike.

    ``values`` has distinct (kind, value). A surrogate is never a value of its kind either.
    """
    taken, rest = None, values
    for attempt in count():
        digest = F.sha2(F.concat_ws("|", F.lit(key), "kind", "value", F.lit(str(attempt))), 512)
        made = work.write(
            rest.withColumn("digest", digest).select(
                "kind",
                "value",
                _surrogate(F.col("kind"), F.col("value"), F.col("digest"), attempt).alias("surrogate"),
            ),
            f"drawn-{attempt}",
        )
        real = values.select("kind", F.col("value").alias("surrogate"))
        used = real if taken is None else real.union(taken.select("kind", "surrogate"))
        free = made.join(used, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        first = first.select("kind", "value", "surrogate")
        taken = work.write(first if taken is None else taken.union(first), f"taken-{attempt}")
        rest = made.join(taken, ["kind", "value"], "left_anti").select("kind", "value")
        rest = work.write(rest, f"rest-{attempt}")
        if rest.isEmpty():
            return taken


def _filled(text: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the format of the mention it replaces."""
    separator = "[ ().-]"

    def one(char: Column, at: Column) -> Column:
        so_far = F.regexp_replace(F.substring(text, F.lit(1), at + 1), separator, "")
        return F.when(char.rlike(separator), char).otherwise(
            F.substring(surrogate, F.length(so_far), F.lit(1))
        )

    spaced = F.array_join(F.transform(F.split(text, ""), one), "")
    # What a wider surrogate has beyond the mention.
    own = F.length(F.regexp_replace(text, separator, ""))
    spaced = F.concat(spaced, F.substring(surrogate, own + 1, F.length(surrogate)))
    return F.when(kind.isin("phone", "card", "ssn", "iban"), spaced).otherwise(surrogate)


# --- over a table --------------------------------------------------------------------


def replace_pii(documents: DataFrame, key: str = "parcelyard") -> DataFrame:
    """``doc_id, text, n_entities, kinds`` of every row, entities replaced.

    ``documents`` needs doc_id and text; other columns are ignored. A null text stays null
    and an empty one empty. Repeated rows are each rewritten, alike. Texts without
    entities are returned as they are. ``kinds`` lists the entities' types in order. The
    same key gives the same surrogates for the same table. An empty table gives an empty
    result.
    """
    work = Workspace(documents.sparkSession, "pii")
    rows = documents.select("doc_id", "text")
    mentions = F.when(F.col("text").rlike(SIGN), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    found = rows.withColumn("mentions", mentions)
    has = F.coalesce(F.size("mentions") > 0, F.lit(False))
    touched = work.write(
        found.where(has).withColumn("row", F.monotonically_increasing_id()), "touched"
    )
    parts = touched.select(
        "row", F.posexplode(F.transform("mentions", _parts)).alias("mention", "parts")
    ).select("row", "mention", F.posexplode("parts").alias("part", "piece"))
    parts = parts.select(
        "row",
        "mention",
        "part",
        F.col("piece.kind").alias("kind"),
        F.col("piece.text").alias("mentioned"),
        _value(F.col("piece.kind"), F.col("piece.text")).alias("value"),
    )
    parts = work.write(parts, "parts")
    values = work.write(
        parts.where("kind is not null").select("kind", "value").distinct(), "values"
    )
    changed = parts.join(surrogates(work, values, key), ["kind", "value"], "left").select(
        "row",
        "mention",
        "part",
        "kind",
        F.when(
            F.col("surrogate").isNotNull(),
            _filled(F.col("mentioned"), F.col("kind"), F.col("surrogate")),
        )
        .otherwise(F.col("mentioned"))
        .alias("written"),
    )
    per_mention = changed.groupBy("row", "mention").agg(
        F.array_sort(F.collect_list(F.struct("part", "written", "kind"))).alias("parts")
    )
    per_row = per_mention.groupBy("row").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "mention",
                    F.array_join(F.transform("parts", lambda p: p["written"]), "").alias("written"),
                    F.array_join(F.transform("parts", lambda p: p["kind"]), " ").alias("kind"),
                )
            )
        ).alias("changes")
    )
    between = F.split("text", ANY, -1)
    rewritten = touched.join(per_row, "row").select(
        "doc_id",
        F.array_join(
            F.flatten(
                F.zip_with(
                    between,
                    F.transform("changes", lambda c: c["written"]),
                    lambda kept, new: F.array(kept, F.coalesce(new, F.lit(""))),
                )
            ),
            "",
        ).alias("text"),
        F.size("mentions").cast("long").alias("n_entities"),
        F.array_join(F.transform("changes", lambda c: c["kind"]), ",").alias("kinds"),
    )
    plain = found.where(~has).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds")
    )
    return rewritten.unionByName(plain)
