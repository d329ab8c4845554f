"""Personal data: detected entities get keyed surrogates of their own kind.

One pattern finds mentions; each has a kind and a normal form (digits of a phone number, lower case
of an address, the parts of a name), and equal normal forms are one entity everywhere, so mentions that
differ in layout keep their coreference. A surrogate is drawn from a keyed digest: digits for digits,
letters for letters of the same case and script, names of the same gender and script, check digits that hold where the
mention's held, and is written in the mention's own layout.

A name is found by a title, a cue such as "my name is", or a common given name before it. Its words are entities: a person keeps one
surrogate with and without a title, and the gender is what lists and titles of the whole corpus say of the word. Full names found so are
then replaced in runs of capitalised words of all documents, where nothing else tells that they are names. A surname alone is found after a title only. Pieces of hyphenated names are entities of their own, particles stay, and a name that NOT_NAMES goes on with is none.

Surrogates are checked over the whole corpus: one that another entity of its kind has, or that is itself an entity of
the corpus, is drawn anew until none is left, so distinct entities stay distinct.
All by DataFrame functions; only documents with a mention or a run of capitalised words move, and an entity of many documents is dealt over salts.

Defined results. Null text: stays null, no mentions. Text without mentions: unchanged. Null doc_id and
repeated rows: each row treated alike. Empty table: empty result. Very long texts: whole; the pattern's
parts are bounded or give nothing back, so time grows with the length. Digits in a row that fail the Luhn test and are not 16 are no card number; names in other
cased scripts than Latin, Cyrillic and Greek get Latin surrogates. Extra columns of any name are kept; those named n_mentions or kinds are replaced. n_chars, if there, is counted anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .common import Scratch, fresh, salted_join

KEY = "surrogate-key-1"
ATTEMPTS = 60

#: Titles that precede a name, and common given names, by gender.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Г-жа"), "n": ("Dr", "Prof")}
GIVEN = {
    "m": ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Hans", "Klaus", "Jürgen", "Pierre", "Jean", "Luc", "José", "Carlos", "Juan", "Miguel", "Иван", "Пётр", "Сергей", "George", "Daniel", "Mark", "Alexander", "Ali", "Ahmed", "Mohammed", "Omar", "Wei", "Hiroshi", "Raj", "Arjun", "Marco", "Giovanni", "Luis", "Pedro", "Jan", "Lars", "Γιώργος", "Γεώργιος", "Νίκος"),
    "f": ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Anna", "Emma", "Ursula", "Monika", "Marie", "Claire", "Sophie", "María", "Carmen", "Lucía", "Elena", "Ольга", "Мария", "Maria", "Laura", "Julia", "Karen", "Emily", "Alice", "Olivia", "Aisha", "Fatima", "Layla", "Mei", "Yuki", "Priya", "Ananya", "Giulia", "Chiara", "Ana", "Ingrid", "Katarina", "Ελένη", "Μαρία"),
}
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True)) + r")\.?"
_GIVEN = "(?:" + "|".join(n for ns in GIVEN.values() for n in ns) + ")"
#: Words that follow a given name or a cue without being a name: offices, roles, places, and words that a given name may be, too.
NOT_NAMES = ("Account", "Accounts", "Admin", "Administrator", "Adviser", "Agent", "Avenue", "Bank", "Bay", "Board", "Boulevard", "Bridge", "Captain", "Center", "Centre", "Chair", "Church", "City", "Client", "Club", "Coach", "Code", "College", "Colleague", "Colleagues", "Committee", "Company", "Council", "County", "Customer", "Customers", "Department", "Desk", "Director", "Down", "Drive", "Editor", "Editors", "Engineer", "Everyone", "Everybody", "Family", "Finance", "Friend", "Friends", "Group", "Guest", "Guests", "Help", "Hill", "Hiring", "Hospital", "House", "Human", "Island", "Lake", "Lane", "Language", "Madam", "Manager", "Managers", "Market", "Member", "Members", "Ministry", "Museum", "Office", "Officer", "Out", "Park", "Parents", "Place", "Police", "President", "Prize", "Professor", "Purchasing", "Quarter", "Reader", "Readers", "Recruiter", "Recruiting", "Resident", "Residents", "Resources", "River", "Road", "Sales", "School", "Service", "Services", "Sir", "Sirs", "Square", "Staff", "Station", "Street", "Student", "Students", "Subscriber", "Supervisor", "Support", "Teacher", "Team", "Technical", "Tower", "University", "Up", "User", "Users", "Valued", "Village", "Way")
#: Words between a given name and a surname that stay as they are.
PARTICLES = ("von", "van", "der", "den", "de", "del", "della", "di", "da", "dos", "das", "du", "la", "le", "al", "bin", "ibn", "ter", "zu", "Von", "Van", "Der", "Den", "De", "Del", "Della", "Di", "Da", "Dos", "Du", "La", "Le", "Al", "Bin")
_PIECE = r"\p{Lu}[\p{L}'’]++"
_PART = rf"{_PIECE}(?:-{_PIECE})*+(?!\p{{N}})"
_AFTER = rf" (?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_PART}"
_NO_NAME = rf"(?!(?:{'|'.join(NOT_NAMES)})(?![\p{{L}}\p{{N}}]))"
#: What introduces a full name.
_CUE = r"(?:[Nn]ame is|named|[Nn]ame:|[Cc]ontact:|Dear|Sincerely,|[Rr]egards,|[Ss]igned,|appelle|heiße|[Nn]ame ist|llamo|nombre es)"
_KEY_PREFIX = r"(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|eyJ)"

#: Kinds in the order in which they are tried. A run is no mention of its own: full names found elsewhere are looked up in it.
PATTERNS = {
    "key": r"(?<![\p{L}\p{N}])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}+|sk-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![\p{L}\p{N}])",
    "secret": r"""(?<![\p{L}\p{N}])(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?[^\s"']{7,}[^\s"'.,;:!?)\]}]""",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?<!(?i:version|release|ver|v)[. ]{1,2})(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?[\p{L}\p{N}])",
    "ipv6": r"(?<![\p{L}\p{N}:.])(?=(?:[0-9A-Fa-f]{0,4}:){3})(?=[A-Fa-f:]{0,39}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){2,7}:|::(?:[0-9A-Fa-f]{1,4}:){1,6}[0-9A-Fa-f]{1,4})(?![\p{L}\p{N}:])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "phone": r"(?:(?<![\p{L}\p{N}+.-])0\d{1,4}[ /-]\d{5,8}|(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,5}){1,5}|(?<![\p{L}\p{N}])\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\p{L}\p{N}.-])\d{3}[ .-]\d{3}[ .-]\d{4})(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]?\d{1,4})?)(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE} {_PART}(?:{_AFTER})?|{_CUE} (?!{_TITLE} ){_NO_NAME}{_PART}(?! (?:{'|'.join(NOT_NAMES)})(?![\p{{L}}\p{{N}}])){_AFTER}|{_GIVEN}(?:-{_PIECE})*+(?! (?:{'|'.join(NOT_NAMES)})(?![\p{{L}}\p{{N}}])){_AFTER})",
    "run": rf"(?<![\p{{L}}\p{{N}}])(?!{_TITLE} ){_PART}(?: (?!{_TITLE} |{_GIVEN} ){_PART})++",
}
#: What a mention of a kind can begin with: a cheap look ahead of the pattern itself.
_BEGINS = {"key": "[AgsxeJ]", "secret": "[tTsSpPaA]", "email": "", "iban": "[A-Z]", "ip": r"\d", "ipv6": "[0-9A-Fa-f:]", "ssn": r"\d", "phone": r"[+(\d]", "card": r"\d", "name": r"[\p{Lu}nclrsah]", "run": r"\p{Lu}"}
#: Matches of this are mentions but for digits that fail the Luhn test; ``ANY`` finds runs too.
SURE = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "run") + ")"
#: All kinds begin where no letter or digit precedes, which one look behind settles for most positions of a text.
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{f'(?={_BEGINS[k]})' if _BEGINS[k] else ''}{p})" for k, p in PATTERNS.items()) + ")"
_SECRET_VALUE = r"""^([^=:]*[=:]\s{0,3}["']?)([^\s"']+)$"""
#: Syllables from which names are built, by script.
_ONSETS = {"latin": list("bdfgklmnprstvz"), "cyrillic": list("бдгклмнпрствз"), "greek": list("βγδζκλμνπρστ")}
_VOWELS = {"latin": list("aeiou"), "cyrillic": list("аеиоу"), "greek": list("αειου")}
_ENDS = {"latin": {"m": "on", "f": "a", "n": "is"}, "cyrillic": {"m": "он", "f": "а", "n": "ис"}, "greek": {"m": "ος", "f": "α", "n": "ις"}}
#: Letters from which others than a-z are drawn, by script.
_LETTERS = {r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω", r"\p{IsLatin}": "àáâäåæçèéêëíîïñóôöøúûüß"}


def _lits(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def kind_of(mention: Column) -> Column:
    return F.coalesce(*(F.when(mention.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()), F.lit("name"))


def _word_entities(word: Column, part: str, gender: Column | None = None) -> Column:
    """One entity for each piece of a hyphenated word; none for a particle."""
    return F.when(word.isin(*PARTICLES), F.array().cast("array<struct<kind:string,norm:string,gender:string>>")).otherwise(F.transform(F.split(word, "-"), lambda p: _word_entity(p, part, gender)))


def _name_parts(mention: Column) -> Column:
    """The words of a name mention without its title or cue."""
    return F.split(F.regexp_replace(mention, rf"^(?:{_TITLE}|{_CUE}) ", ""), " ")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), F.lit("cyrillic")).when(word.rlike(r"^\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))


def _gender(word: Column, mention: Column) -> Column:
    by_name = [F.when(word.isin(*names), F.lit(g)) for g, names in GIVEN.items()]
    by_title = [F.when(mention.rlike(rf"^(?:{'|'.join(ts)})\.? "), F.lit(g)) for g, ts in TITLES.items()]
    return F.coalesce(*by_name, *by_title, F.lit("n"))


def _entity(kind: Column, norm: Column, gender: Column | None = None) -> Column:
    return F.struct(kind.alias("kind"), norm.alias("norm"), (F.lit("n") if gender is None else gender).alias("gender"))


def _word_entity(word: Column, part: str, gender: Column | None = None) -> Column:
    return _entity(F.concat_ws("_", F.lit(part), _script(word)), F.lower(word), gender)


def matches_in(text: Column) -> Column:
    """Each match of ANY in a text as ``m``, its kind ``k``, and whether it is a mention of its own."""
    return F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: let(kind_of(m), lambda k: F.struct(m.alias("m"), k.alias("k"), _is_mention(m, k).alias("sure"))))


def _is_mention(mention: Column, kind: Column) -> Column:
    """Whether a match is a mention of its own: runs are not, nor digits in a row that fail the Luhn test and are not 16."""
    row = mention.rlike(r"^\d+$")
    return (kind != "run") & ~((kind == "card") & row & (F.length(mention) != 16) & (luhn(F.when(row, mention).otherwise("0")) != 0))


def _pairs_of(run: Column) -> Column:
    """Each two words that follow each other in a run, lower-cased, as ``pair`` entities."""
    words = F.split(run, " ")
    return F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.struct(F.concat_ws(" ", F.lower(a), F.lower(b)).alias("pair"), F.concat(_word_entities(a, "given"), _word_entities(b, "surname")).alias("words")))


def entities_of(mention: Column, kind: Column) -> Column:
    """The entities of one mention: one (kind, normal form, gender), or one for each part of a name."""
    digits = F.regexp_replace(mention, r"\D", "")
    norm = (
        F.when(kind == "secret", F.regexp_extract(mention, _SECRET_VALUE, 2))
        .when(kind.isin("email", "ipv6"), F.lower(mention))
        .when(kind == "key", mention)
        .when(kind == "ip", mention)
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when((kind == "phone") & mention.startswith("+"), F.concat(F.lit("+"), digits))
        .otherwise(digits)
    )
    parts = _name_parts(mention)
    count = F.size(parts)
    of_name = F.flatten(F.transform(parts, lambda w, i: F.when((i == 0) & (count > 1), _word_entities(w, "given", _gender(F.substring_index(w, "-", 1), mention))).otherwise(_word_entities(w, "surname"))))
    return F.when(kind == "name", of_name).otherwise(F.array(_entity(kind, norm)))


def _number(digest: Column, i: Column) -> Column:
    """The i-th of 32 numbers below 65536 in a digest, cyclically."""
    return F.conv(F.substring(digest, i % 32 * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _scrambled(text: Column, digest: Column, keep: Column, hexes: Column) -> Column:
    """Each character after the first ``keep`` drawn anew within its class; others as they are."""
    lower, upper = _lits(list("abcdefghijklmnopqrstuvwxyz")), _lits(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    def draw(c: Column, i: Column) -> Column:
        n, few = _number(digest, i), F.when(hexes, 6).otherwise(26)
        return F.when(i < keep, c).when(c.between("0", "9"), (n % 10).cast("string")).when(c.between("a", "z"), F.element_at(lower, n % few + 1)).when(c.between("A", "Z"), F.element_at(upper, n % few + 1)).when(c.rlike(r"\p{L}"), other(c, n)).otherwise(c)

    def other(c: Column, n: Column) -> Column:
        drawn = F.lit(None).cast("string")
        for script, letters in _LETTERS.items():
            drawn = F.when(c.rlike(script), F.element_at(_lits(list(letters)), n % len(letters) + 1)).otherwise(drawn)
        drawn = F.coalesce(drawn, F.element_at(lower, n % 26 + 1))
        return F.when(c == F.upper(c), F.upper(drawn)).otherwise(drawn)

    return F.array_join(F.transform(_chars(text), draw), "")


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits."""

    def add(total: Column, c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    values = F.transform(_chars(F.reverse(digits)), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(values, F.lit(0), lambda t, x: add(t, x["c"], x["i"])) % 10


def mod97(iban: Column) -> Column:
    """The remainder of an IBAN by 97, its first four characters moved to the end and letters read as 10 to 35: 1 where the check digits hold."""

    def add(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.left(iban, F.lit(4)))), F.lit(0), add)


def _invented(kind: Column, gender: Column, digest: Column, syllables: Column) -> Column:
    out = F.lit(None).cast("string")
    for script in _ONSETS:
        onsets, vowels = _lits(_ONSETS[script]), _lits(_VOWELS[script])
        body = F.array_join(F.transform(F.sequence(F.lit(0), syllables - 1), lambda i: F.concat(F.element_at(onsets, _number(digest, 2 * i) % len(_ONSETS[script]) + 1), F.element_at(vowels, _number(digest, 2 * i + 1) % len(_VOWELS[script]) + 1))), "")
        for g, end in _ENDS[script].items():
            out = F.when(kind.endswith(f"_{script}") & (gender == g), F.concat(body, F.element_at(onsets, _number(digest, F.lit(31)) % len(_ONSETS[script]) + 1), F.lit(end))).otherwise(out)
    return out


def candidate(kind: Column, norm: Column, gender: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate that a kind, normal form and gender get at this attempt, in normal form."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")), 512)
    scrambled = _scrambled(norm, digest, F.when(kind == "iban", 2).when(kind == "key", F.length(F.regexp_extract(norm, f"^{_KEY_PREFIX}", 0))).when((kind == "phone") & norm.startswith("+"), 2).when(kind == "card", 1).otherwise(0), (kind == "ipv6") | (kind == "secret") & norm.rlike("^[0-9a-fA-F]+$"))
    # A number that passed the Luhn test gets a last digit with which the surrogate passes too.
    stem = F.concat(F.left(scrambled, F.length(scrambled) - 1), F.lit("0"))
    card = F.when(luhn(norm) == 0, F.concat(F.left(stem, F.length(stem) - 1), ((10 - luhn(stem)) % 10).cast("string"))).otherwise(scrambled)
    # Likewise the two check digits of an account number.
    body = F.substring(scrambled, F.lit(5), F.length(scrambled))
    zero = F.concat(F.left(norm, F.lit(2)), F.lit("00"), body)
    iban = F.when(mod97(norm) == 1, F.concat(F.left(norm, F.lit(2)), F.lpad((98 - mod97(zero)).cast("string"), 2, "0"), body)).otherwise(scrambled)
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    host = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)
    # Equal domains stay equal; the host lies under a reserved name.
    email = F.concat(_scrambled(local, digest, F.lit(0), F.lit(False)), F.when(attempt > 3, F.left(digest, attempt - 3)).otherwise(""), F.lit("@"), F.translate(F.left(host, F.lit(10)), "0123456789", "ghijklmnop"), F.lit(".example."), F.when(domain.rlike(r"\.(com|net|org)$"), F.substring_index(domain, ".", -1)).otherwise("org"))
    ip = F.concat_ws(".", F.when(attempt < 20, _number(digest, F.lit(0)) % 16 + 240).otherwise(_number(digest, F.lit(0)) % 256).cast("string"), *((_number(digest, F.lit(i)) % 256).cast("string") for i in (1, 2, 3)))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "iban", iban).when(kind.contains("_"), _invented(kind, gender, digest, F.least(F.lit(2) + F.floor(attempt / 4).cast("int"), F.lit(8)))).otherwise(scrambled)


def surrogates(entities: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """kind, norm, surrogate of every distinct entity (kind, norm and perhaps gender); no two of a kind alike, none an entity of its kind itself.

    The gender is the one that its mentions have, none if they differ.
    """
    seen = lambda g: F.max(F.col("gender") == g)
    gender = F.when(seen("m") & ~seen("f"), "m").when(seen("f") & ~seen("m"), "f").otherwise("n")
    if "gender" not in entities.columns:
        entities = entities.withColumn("gender", F.lit("n"))
    mine = scratch.put(entities.groupBy("kind", "norm").agg(gender.alias("gender")))
    taken = mine.select("kind", F.col("norm").alias("surrogate"))
    done, open_ = [], mine
    for attempt in range(ATTEMPTS):
        drawn = open_.withColumn("surrogate", candidate(F.col("kind"), F.col("norm"), F.col("gender"), F.lit(attempt), key))
        # Of those that draw one surrogate the least goes first; the others, and any that meets what is taken, draw again.
        first = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")).join(taken, ["kind", "surrogate"], "left_anti")
        good = scratch.put(first.select("kind", "norm", "surrogate"))
        done.append(good)
        open_ = scratch.put(open_.join(good.select("kind", "norm"), ["kind", "norm"], "left_anti"))
        if open_.isEmpty():
            return reduce(DataFrame.unionAll, done)
        taken = taken.unionAll(good.select("kind", "surrogate"))
    raise ValueError(f"no free surrogate after {ATTEMPTS} attempts: more entities of a kind than it has forms")


def _names_in_run(run: Column, known: Column) -> Column:
    """A run of capitalised words with the full names that are known replaced."""
    words = F.split(run, " ")
    pair = lambda a, b: F.try_element_at(known, F.concat(F.lit("pair:"), F.lower(a), F.lit(" "), F.lower(b))).isNotNull()
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("second"))

    def step(s: Column, x: Column) -> Column:
        opens = ~s["second"] & F.coalesce(pair(x["w"], x["next"]), F.lit(False))
        word = F.when(s["second"], _word_laid(x["w"], "surname", known)).when(opens, _word_laid(x["w"], "given", known)).otherwise(x["w"])
        return F.struct(F.concat(s["out"], F.array(word)).alias("out"), opens.alias("second"))

    with_next = F.transform(words, lambda w, i: F.struct(w.alias("w"), F.get(words, i + 1).alias("next")))
    return F.array_join(F.aggregate(with_next, start, step, lambda s: s["out"]), " ")


def _surrogate(entity: Column, known: Column) -> Column:
    return F.try_element_at(known, F.concat_ws(":", entity["kind"], entity["norm"]))


def _cased(surrogate: Column, word: Column) -> Column:
    return F.when(word == F.upper(word), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def _word_laid(word: Column, part: str, known: Column) -> Column:
    """A word of a name with the surrogates of its pieces; particles as they are."""
    return F.when(word.isin(*PARTICLES), word).otherwise(F.array_join(F.transform(F.split(word, "-"), lambda p: _cased(_surrogate(_word_entity(p, part), known), p)), "-"))


def _written(mention: Column, kind: Column, sure: Column, known: Column) -> Column:
    """A mention in its own layout with the surrogates of its entities; other matches as they are."""
    return F.when(kind == "run", _names_in_run(mention, known)).when(sure, let(entities_of(mention, kind), lambda e: _surrogates_laid(mention, kind, e, known))).otherwise(mention)


def _surrogates_laid(mention: Column, kind: Column, entities: Column, known: Column) -> Column:
    """As the mention is written: names word by word, addresses and keys whole, numbers sign by sign."""
    words = _name_parts(mention)
    parts = F.transform(words, lambda w, i: F.when((i == 0) & (F.size(words) > 1), _word_laid(w, "given", known)).otherwise(_word_laid(w, "surname", known)))
    name = F.concat(F.regexp_extract(mention, rf"^((?:{_TITLE}|{_CUE}) )?", 1), F.array_join(parts, " "))
    return F.when(kind == "name", name).otherwise(let(_surrogate(F.element_at(entities, 1), known), lambda one: _one_laid(mention, kind, one)))


def _one_laid(mention: Column, kind: Column, one: Column) -> Column:
    signs = _chars(F.regexp_replace(one, r"[^\p{L}\p{N}]", ""))
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    laid = F.aggregate(_chars(mention), start, lambda s, c: F.when(c.rlike(r"[\p{L}\p{N}]"), F.struct(F.concat(s["out"], F.coalesce(F.try_element_at(signs, s["at"]), c)).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))), lambda s: s["out"])
    return F.when(kind == "secret", F.concat(F.regexp_extract(mention, _SECRET_VALUE, 1), one)).when(kind.isin("email", "ip", "key"), one).otherwise(laid)


def replace_entities(docs: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and n_mentions and kinds."""
    own = [c for c in docs.columns if c not in ("n_mentions", "kinds")]
    every = [F.col(f"`{c}`") for c in own]
    docs = docs.select(*every)
    matches, doc, map_, new = fresh(docs, "matches", "doc", "known", "new")
    has = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    clean = docs.where(~has).select(*every, F.lit(0).alias("n_mentions"), F.lit("").alias("kinds"))
    # Written once, so that the pattern runs over all texts twice only: here and for those without a match.
    found = scratch.put(docs.where(has).withColumn(matches, matches_in(F.col("text"))).withColumn(doc, F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"))))

    mentions = F.filter(matches, lambda x: x["sure"])
    per_doc = found.select(F.col(doc).alias("doc"), F.explode(F.array_distinct(F.flatten(F.transform(mentions, lambda x: entities_of(x["m"], x["k"]))))).alias("e")).select("doc", "e.*").distinct()
    # Full names that mentions show, and the runs of all documents in which they occur again.
    full = F.filter(F.transform(F.filter(mentions, lambda x: x["k"] == "name"), lambda x: _name_parts(x["m"])), lambda p: F.size(p) == 2)
    names = found.select(F.explode(full).alias("p")).select(F.concat_ws(" ", F.lower(F.col("p")[0]), F.lower(F.col("p")[1])).alias("pair")).distinct()
    runs = F.array_distinct(F.flatten(F.transform(F.filter(matches, lambda x: x["k"] == "run"), lambda x: _pairs_of(x["m"]))))
    again = scratch.put(salted_join(found.select(F.col(doc).alias("doc"), F.explode(runs).alias("r")).select("doc", "r.*"), scratch.put(names), "pair", ["doc"], "inner").distinct())
    per_doc = per_doc.unionByName(again.select("doc", F.explode("words").alias("e")).select("doc", "e.*"))
    per_doc = scratch.put(per_doc.withColumn("entity", F.concat_ws(":", "kind", "norm")))

    named = surrogates(per_doc, scratch, key).select(F.concat_ws(":", "kind", "norm").alias("entity"), "surrogate")
    known = salted_join(per_doc.select("doc", "entity").distinct(), named, "entity", ["doc"], "inner").select("doc", "entity", "surrogate")
    known = known.unionByName(again.select("doc", F.concat(F.lit("pair:"), "pair").alias("entity"), F.lit("").alias("surrogate")))
    known = known.distinct().groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias(map_)).withColumnRenamed("doc", doc)

    gaps = F.split("text", ANY, -1)
    laid = F.transform(matches, lambda x: _written(x["m"], x["k"], x["sure"], F.col(map_)))
    joined = found.join(known, doc, "left")
    changed_at = F.filter(F.arrays_zip(F.col(matches).alias("m"), F.col(new).alias("w")), lambda z: z["m"]["m"] != z["w"])
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform(changed_at, lambda z: F.when(z["m"]["k"] == "run", "name").otherwise(z["m"]["k"])))), ",")
    seen = joined.withColumn(new, F.when(F.col(map_).isNull(), F.transform(matches, lambda x: x["m"])).otherwise(laid))
    text = F.array_join(F.zip_with(gaps, F.concat(F.col(new), F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
    out_text = F.when(F.col(map_).isNull(), F.col("text")).otherwise(text)
    changed = seen.select(*(out_text.alias("text") if c == "text" else F.col(f"`{c}`") for c in own), F.size(changed_at).alias("n_mentions"), kinds.alias("kinds"))
    out = clean.unionByName(changed)
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.when(F.col("n_mentions") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
