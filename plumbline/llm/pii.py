"""Surrogates for personal data and secrets, in DataFrame functions only.

One pattern finds the entities: e-mail addresses, IPv4 addresses, phone, card and social security numbers, IBANs,
access keys, assigned passwords and tokens, and titled names. The words of a text's titled names are then looked for in
that text without their title, too, so that "Smith" after "Mr John Smith" doesn't stay. No part of the pattern is
matched by recursion, and none starts anew inside a run that it has read, so any text takes time in its length.

Each entity has a canonical form (lower-cased address, national digits of a phone number, digits without punctuation,
value without its assignment, one word of a name), so that all mentions, however written, get one replacement. It is
derived from a keyed SHA-256 of type, canonical form and an attempt number, and has the original's kind: digits for
digits, letters of the same script and case, hexadecimal for hexadecimal, check digits of cards and IBANs, country and
issuer prefixes and all punctuation kept. Name words are put together from syllables of the same script with an ending
of their gender: that of the titles before which the word is a given name anywhere in the table, and a neutral one
where titles of both genders or none say so.

Distinct entities must stay distinct: over all entities of the table, replacements that meet, or that equal an entity
of the table, are derived again with the next attempt; the least canonical form keeps the contested one. A form so
dense that ``MAX_ATTEMPTS`` find no free place (nearly all nine-digit numbers in one table) gives way to a keyed tag,
``[ssn 0123...]``, which keeps distinctness and coreference before format. The table of entities is distributed;
nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.store import discard, keep

MALE = "Mr|Herr|Señor|Monsieur|Г-н|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mme|Mlle|Г-жа|Κυρία"
NEUTRAL = "Dr|Prof|Professor"
_TITLE = rf"(?:{MALE}|{FEMALE}|{NEUTRAL})\.? "
_ASSIGN = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}\p{M}'’-]+"
_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: Words before four numbers with points that make them a version and no address.
_NO_IP = r"(?<!(?i:version|release|build|firmware|section)[ :=]{1,2})"
#: A number that goes on after a blank, point or hyphen is part of a longer one.
_NO_MORE = r"(?![ .-]?\p{N})"

# Every alternative begins where a letter or digit doesn't precede; a look at the first character leaves out the others.
PATTERN = _EDGE + "(?:" + "|".join(
    [
        rf"(?=[PpSsTtAa])(?:{_ASSIGN}[A-Za-z0-9+/_~.-]{{5,}}[A-Za-z0-9+/_~]|sk-[A-Za-z0-9]{{20,}}{_END})",
        rf"(?=A|gh)(?:AKIA[0-9A-Z]{{16}}|ghp_[A-Za-z0-9]{{36}}){_END}",
        r"(?<![._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
        rf"(?=\p{{Lu}})(?:[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}|{_TITLE}{_NAME}(?: {_NAME}){{0,2}})",
        r"(?=[\d(+])(?:"
        + "|".join(
            [
                rf"(?<!\.){_NO_IP}{_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\p{{N}})",
                r"\d{3}-\d{2}-\d{4}(?![\p{N}-])",
                r"(?:\d{4}[ -]?){3}\d{1,7}(?!\p{N})",
                r"(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\p{N})",
                r"\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\p{N})",
                rf"(?<![.-])(?<!\d )\d{{3}}[ .-]\d{{3}}[ .-]\d{{4}}{_NO_MORE}",
                rf"(?<![.-])(?<!\d )1[3-9]\d{{9}}{_NO_MORE}",
            ]
        )
        + ")",
    ]
) + ")"
MAX_ATTEMPTS = 16

#: Country calling codes of one and two digits; all others have three (fixed values).
_COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

# Syllables of made-up names by script, and their endings by gender (fixed values).
_SCRIPTS = {
    "latin": (["ba", "ve", "lo", "ri", "ma", "ne", "do", "ka", "si", "te", "ju", "fa", "go", "hi", "pe", "zu"], {"m": ["ron", "las", "bert", "vin"], "f": ["lina", "rea", "dora", "mia"], "n": ["len", "ris", "quin", "sol"]}),
    "cyrillic": (["ба", "ве", "ло", "ри", "ма", "не", "до", "ка", "си", "те", "жу", "фа", "го", "ми", "пе", "зу"], {"m": ["рон", "слав", "тин", "мир"], "f": ["лина", "рея", "дора", "мия"], "n": ["лен", "рис", "ко", "сол"]}),
    "greek": (["βα", "βε", "λο", "ρι", "μα", "νε", "δο", "κα", "σι", "τε", "γα", "φα", "γο", "χι", "πε", "ζη"], {"m": ["ρος", "λας", "νος", "τος"], "f": ["λινα", "ρεα", "δωρα", "μια"], "n": ["λεν", "ρις", "σολ", "κι"]}),
    "armenian": (["բա", "վե", "լո", "րի", "մա", "նե", "դո", "կա", "սի", "տե", "ժու", "ֆա", "գո", "հի", "պե", "զու"], {"m": ["րոն", "լաս", "վին", "մեն"], "f": ["լինա", "ռեա", "դորա", "միա"], "n": ["լեն", "րիս", "կին", "սոլ"]}),
}
# Letters that stand for letters of a script: the script's class, small letters, capitals or none (fixed values).
_LETTERS = [
    (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{IsArmenian}", "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ", "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՓՔՕՖ"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת", None),
    (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", None),
    (r"\p{IsDevanagari}", "अआइउएकखगघचजटडतथदधनपबमयरलवसह", None),
    (r"\p{IsThai}", "กขคงจชดตถทนบปพมยรลวสหอ", None),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보소오조초", None),
    (r"\p{IsHiragana}|\p{IsKatakana}", "あいうえおかきくけこさしすせそたちつてとなにぬねの", None),
    (r"\p{IsHan}", "安白成德方高国海和建江金立林明平青山石水天文新永", None),
]
_LATIN = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _titled(value: Column, titles: str) -> Column:
    return value.rlike(rf"^(?:{titles})\.? \p{{Lu}}")


def _entity(value: Column) -> Column:
    """Type of one match."""
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (
        F.when(value.rlike(rf"^{_ASSIGN}"), "secret")
        .when(value.contains("@"), "email")
        .when(value.rlike("^(?:AKIA[0-9A-Z]{16}$|ghp_|sk-)"), "key")
        .when(value.rlike(r"^[A-Z]{2}\d\d"), "iban")
        .when(value.rlike(r"^\p{L}"), "name")
        .when(value.rlike(r"^\d+(?:\.\d+){3}$") & ~value.rlike(r"^\d{3}\.\d{3}\.\d{4}$"), "ip")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when((digits >= 13) & ~value.startswith("+"), "card")
        .otherwise("phone")
    )


def _name_units(value: Column) -> Column:
    """The words of a name, or their parts around hyphens and apostrophes; the last word is the family name."""
    title = F.regexp_extract(value, f"^{_TITLE}", 0)
    rest = F.substr(value, F.length(title) + 1)
    words = F.split(rest, " ")
    between = F.concat(F.array(title), F.regexp_extract_all(rest, F.lit(" |['’-]+"), F.lit(0)))
    parts = F.flatten(F.transform(words, lambda w, k: F.transform(F.split(w, "['’-]+"), lambda p: F.struct(p.alias("raw"), (k < F.size(words) - 1).alias("given")))))
    male, female = _titled(value, MALE), _titled(value, FEMALE)
    return F.transform(
        parts,
        lambda p, j: F.struct(
            F.when(F.length(p["raw"]) > 1, "name").alias("type"),  # an initial stays
            F.lower(p["raw"]).alias("canon"),
            p["raw"].alias("raw"),
            F.get(between, j).alias("lead"),
            (p["given"] & male).alias("m"),
            (p["given"] & female).alias("f"),
        ),
    )


def _units(kind: Column, value: Column) -> Column:
    """What gets a replacement inside one match: itself, or each word of a name; ``lead`` is what stays before it."""
    digits = F.regexp_replace(value, r"\D", "")
    national = F.when(value.startswith("+"), F.regexp_replace(digits, _COUNTRY, "")).otherwise(digits)
    lead = F.when(kind == "secret", F.regexp_extract(value, rf"^{_ASSIGN}", 0)).otherwise("")
    raw = F.substr(value, F.length(lead) + 1)
    canon = (
        F.when(kind == "email", F.lower(raw))
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind == "phone", F.regexp_replace(national, r"^0+(?=\d)", ""))
        .when(kind.isin("card", "ssn"), digits)
        .otherwise(raw)
    )
    no = F.lit(False)
    one = F.array(F.struct(kind.alias("type"), canon.alias("canon"), raw.alias("raw"), lead.alias("lead"), no.alias("m"), no.alias("f")))
    return F.when(kind == "name", _name_units(value)).otherwise(one)


def _letters(text: str) -> Column:
    return F.split(F.lit(text), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often and wherever it stands in there."""
    return F.transform(F.array(value), body)[0]


def _chars(text: Column, seed: Column, kept: Column) -> Column:
    """Each letter or digit replaced by one of its kind, drawn from ``seed`` and its place; the first ``kept`` stay."""
    low, high = map(_letters, _LATIN)
    hexa = _letters("0123456789abcdef")

    def one(s: Column, c: Column, i: Column) -> Column:
        draw = lambda n: F.pmod(F.xxhash64(s["seed"], i + 1), F.lit(n)).cast("int")
        out = F.when(i < s["kept"], c).when(s["hex"], F.get(hexa, draw(16))).when(c.between("0", "9"), draw(10).cast("string"))
        out = out.when(c.between("A", "Z"), F.get(high, draw(26))).when(c.between("a", "z"), F.get(low, draw(26))).when(c < F.lit("\x80"), c)
        for script, small, capitals in _LETTERS:
            of = lambda letters: F.get(_letters(letters), draw(len(letters)))
            out = out.when(c.rlike(script), F.when(c.rlike(r"\p{Lu}"), of(capitals)).otherwise(of(small)) if capitals else of(small))
        return out.when(c.rlike(r"\p{Lu}"), F.get(high, draw(26))).when(c.rlike(r"\p{L}|\p{M}"), F.get(low, draw(26))).otherwise(c)

    given = F.struct(F.split(text, "").alias("c"), text.rlike(r"^(?=[a-f]*+\d)(?=\d*+[a-f])[0-9a-f]++$").alias("hex"), seed.alias("seed"), kept.alias("kept"))
    return _let(given, lambda s: F.array_join(F.transform(s["c"], lambda c, i: one(s, c, i)), ""))


def _luhn(digits: Column) -> Column:
    """``digits`` with the last one made the check digit of the others."""

    def checked(own: Column) -> Column:
        n = F.length(own)
        doubled = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
        total = F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0), lambda acc, i: acc + _let(F.substring(own, i, F.lit(1)).cast("int"), lambda d: F.when((n - i) % 2 == 1, doubled(d)).otherwise(d)))
        return F.concat(F.substring(own, F.lit(1), n - 1), F.pmod(-total, F.lit(10)).cast("string"))

    return _let(digits, checked)


def _iban(canon: Column, seed: Column) -> Column:
    """Country kept, account drawn, check digits so that the whole is 1 modulo 97."""
    country = F.substr(canon, F.lit(1), F.lit(2))

    def checked(account: Column) -> Column:
        digits = F.split(F.concat(account, country, F.lit("00")), "")
        value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        rest = F.aggregate(digits, F.lit(0), lambda acc, c: _let(value(c), lambda v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97))
        return F.concat(country, F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), account)

    return _let(_chars(F.substr(canon, F.lit(5)), seed, F.lit(0)), checked)


def _name(gender: Column, canon: Column, seed: Column, attempt: Column) -> Column:
    def made(script: str) -> Column:
        syllables, endings = _SCRIPTS[script]
        pool = F.array(*map(F.lit, syllables))
        body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + attempt), lambda i: F.get(pool, F.pmod(F.xxhash64(seed, i), F.lit(len(syllables))).cast("int"))), "")
        ending = lambda g: F.get(F.array(*map(F.lit, endings[g])), F.pmod(F.xxhash64(seed, F.lit(0)), F.lit(4)).cast("int"))
        return F.concat(body, F.when(gender == "m", ending("m")).when(gender == "f", ending("f")).otherwise(ending("n")))

    out = F.when(canon.rlike(r"^\p{IsCyrillic}"), made("cyrillic")).when(canon.rlike(r"^\p{IsGreek}"), made("greek"))
    return out.when(canon.rlike(r"^\p{IsArmenian}"), made("armenian")).otherwise(made("latin"))


def _surrogate(key: str, kind: Column, canon: Column, gender: Column, attempt: Column) -> Column:
    """Canonical form of the replacement."""
    text = lambda *parts: F.concat_ws("\x1f", F.lit(key), *parts)
    return _let(F.sha2(text(kind, canon, attempt.cast("string")), 256), lambda seed: _of_seed(text, kind, canon, gender, attempt, seed))


def _of_seed(text, kind: Column, canon: Column, gender: Column, attempt: Column, seed: Column) -> Column:
    more = F.when(attempt > 2, F.substring(seed, F.lit(1), attempt)).otherwise("")  # short forms run out of others
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    hashed = F.sha2(text(F.lit("domain"), domain), 256)
    label = _chars(F.substring_index(domain, ".", 1), hashed, F.lit(0))
    host = (
        F.when(domain.rlike(r"\p{IsCyrillic}"), F.concat(label, F.lit(".испытание")))
        .when(domain.rlike(r"\p{IsGreek}"), F.concat(label, F.lit(".δοκιμή")))
        .otherwise(F.concat(F.lit("m"), F.substring(hashed, 1, 8), F.lit(".example.org")))
    )
    octet = lambda i, least, n: (F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(n)) + least).cast("string")
    ip = F.concat_ws(".", octet(1, 1, 223), octet(2, 0, 256), octet(3, 0, 256), octet(4, 1, 254))
    phone = F.concat(octet(1, 1, 9), _chars(F.substr(canon, F.lit(2)), seed, F.lit(0)))
    return (
        F.when(kind == "email", F.concat(_chars(local, seed, F.lit(0)), more, F.lit("@"), host))
        .when(kind == "ip", ip)
        .when(kind == "phone", phone)
        .when(kind == "card", _luhn(_chars(canon, seed, F.lit(1))))
        .when(kind == "ssn", _chars(canon, seed, F.lit(0)))
        .when(kind == "iban", _iban(canon, seed))
        .when(kind == "key", F.concat(_chars(canon, seed, F.when(canon.startswith("sk-"), 3).otherwise(4)), F.when(canon.startswith("sk-"), more).otherwise("")))
        .when(kind == "secret", F.concat(_chars(canon, seed, F.lit(0)), more))
        .otherwise(_name(gender, canon, seed, attempt))
    )


def _render(kind: Column, raw: Column, sur: Column) -> Column:
    """The replacement as the mention was written; digits are put in from the end, what they don't reach is kept."""
    plain = F.length(F.regexp_replace(raw, "[^A-Za-z0-9]", ""))
    spare = plain - F.length(sur)

    def step(acc: Column, c: Column) -> Column:
        counts = c.rlike("[A-Za-z0-9]")
        at = acc["n"] + 1 - spare
        put = F.when(counts & (at > 0), F.substring(sur, at, F.lit(1))).otherwise(c)
        return F.struct((acc["n"] + counts.cast("int")).alias("n"), F.concat(acc["out"], put).alias("out"))

    # Only forms of bounded length (at most 45 characters) are filled in.
    filled = F.aggregate(F.split(raw, ""), F.struct(F.lit(0).alias("n"), F.lit("").alias("out")), step, lambda acc: acc["out"])
    cased = F.when((F.upper(raw) == raw) & (F.lower(raw) != raw), F.upper(sur)).otherwise(F.initcap(sur))
    return F.when(kind.isNull(), raw).when(sur.startswith("["), sur).when(kind == "name", cased).when(kind.isin("phone", "card", "ssn", "iban"), filled).otherwise(sur)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities(type, canon)``, distinct rows -> the same with ``surrogate``: one each, distinct within a type, and
    none equal to an entity of its type. A column ``gender`` (m, f or n) may say how names end. Written to the shared
    folder. Each round looks at all, and makes anew only what is contested."""
    gender = F.col("gender") if "gender" in entities.columns else F.lit("n")
    made_by = lambda attempt: _surrogate(key, F.col("type"), F.col("canon"), F.col("gender"), attempt)
    first = entities.select("type", "canon", gender.alias("gender"), F.lit(0).alias("attempt"))
    made = keep(first.withColumn("surrogate", made_by(F.lit(0))))
    for attempt in range(1, MAX_ATTEMPTS + 2):
        owners = made.groupBy("type", "surrogate").agg(F.min("canon").alias("owner"), F.count("*").alias("n")).where("n > 1").select("type", "surrogate", "owner")
        contested = made.join(owners, ["type", "surrogate"]).where("canon <> owner").select("type", "canon")
        real = made.select("type", F.col("canon").alias("surrogate"))
        taken = made.join(real, ["type", "surrogate"], "left_semi").select("type", "canon")
        again = keep(contested.union(taken).distinct().withColumn("again", F.lit(1)))
        if again.isEmpty():
            return made.select("type", "canon", "surrogate")
        bumped = made.join(again, ["type", "canon"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0)))
        if attempt <= MAX_ATTEMPTS:
            new = made_by(F.col("attempt"))
        else:
            new = F.concat(F.lit("["), F.col("type"), F.lit(" "), F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), "type", "canon"), 256), 1, 32), F.lit("]"))
        before = made
        made = keep(bumped.select("type", "canon", "gender", "attempt", F.when(F.col("again") == 1, new).otherwise(F.col("surrogate")).alias("surrogate")))
        discard(before)
        discard(again)
    return made.select("type", "canon", "surrogate")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with entities in ``text_col`` replaced, and ``n_entities int``; a same-named column gives way.

    Texts without entities, null and empty texts stay as they are (zero entities). Repeated texts are replaced alike.
    All other columns are kept. Texts are searched once; the rows are written with what was found in them.
    """
    names = [c for c in docs.columns if c != "n_entities"]
    text = F.col(text_col).cast("string")
    find = lambda t, pattern: F.regexp_extract_all(t, pattern, F.lit(0))
    found = docs.select(F.struct(*names).alias("row"), find(text, F.lit(PATTERN)).alias("m"))
    # Words of titled names, the longest first, to be found without a title in the same text.
    words = F.flatten(F.transform(F.filter("m", lambda v: v.rlike(f"^{_TITLE}")), lambda v: F.split(F.regexp_replace(v, f"^{_TITLE}", ""), "[ '’-]+")))
    sized = F.transform(F.filter(F.array_distinct(words), lambda w: w.rlike(r"^\p{Lu}.")), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))
    found = found.withColumn("words", F.transform(F.array_sort(sized), lambda s: s["w"]))
    pattern = F.when(F.size("words") > 0, F.concat(F.lit(f"{PATTERN}|{_EDGE}(?=\\p{{Lu}})(?:"), F.array_join("words", "|"), F.lit(f"){_END}"))).otherwise(F.lit(PATTERN))
    inner = F.col(f"row.`{text_col}`").cast("string")
    found = found.withColumn("m", F.when(F.size("words") > 0, find(inner, pattern)).otherwise(F.col("m")))
    every = keep(found)

    hits = every.where(F.size("m") > 0).withColumn("tk", F.sha2(inner.cast("binary"), 256))
    texts = hits.groupBy(F.struct("tk").alias("k")).agg(F.first("m").alias("m")).select(F.col("k.tk").alias("tk"), "m")
    matches = texts.select("tk", F.posexplode("m").alias("i", "value")).withColumn("kind", _entity(F.col("value")))
    each = keep(matches.select("tk", "i", F.posexplode(_units(F.col("kind"), F.col("value"))).alias("j", "u")).select("tk", "i", "j", "u.*"))
    flags = each.where("type is not null").groupBy("type", "canon").agg(F.max("m").alias("m"), F.max("f").alias("f"))
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("n")
    known = surrogates(flags.select("type", "canon", gender.alias("gender")), key)
    put = each.join(known, ["type", "canon"], "left").select("tk", "i", "j", F.concat("lead", _render(F.col("type"), F.col("raw"), F.col("surrogate"))).alias("new"))
    # Grouped by a struct, so that the join below gets an exchange of its own and AQE can split a text with many copies.
    lists = put.groupBy(F.struct("tk").alias("k")).agg(F.array_sort(F.collect_list(F.struct("i", "j", "new"))).alias("s")).select(F.col("k.tk").alias("tk"), "s")

    cut = hits.withColumn("gaps", F.split(inner, pattern, -1))
    rebuilt = F.concat(F.array_join(F.transform("s", lambda x: F.concat(F.when(x["j"] == 0, F.get("gaps", x["i"])).otherwise(""), x["new"])), ""), F.element_at("gaps", -1))
    changed = cut.join(lists, "tk").withColumn("new", rebuilt)
    out = changed.select(*(F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names), F.size("m").alias("n_entities"))
    clean = every.where(F.coalesce(F.size("m") <= 0, F.lit(True))).select(*(F.col(f"row.`{c}`").alias(c) for c in names), F.lit(0).alias("n_entities"))
    return clean.unionByName(out)
