"""Format-preserving pseudonyms for personal numbers and dates.

A number that passes its own check (Luhn, IBAN modulus, area rules, octet range, calendar) is ranked within the set of
all valid numbers of its format, the rank is permuted by a keyed alternating Feistel network, and the number of the new
rank is written back into the same separators. The permutation depends on the value and the key alone, so equal values
get equal pseudonyms in every document, and different values never meet. The rank lives in Z_a x Z_b with ``a * b``
the exact size of the format, so no cycle walking is needed. Round values are HMAC-SHA-256.

E-mail addresses have no bounded format; they get a keyed digest below ``.invalid``.

Defined results: NULL stays NULL without finds; numbers that fail their check stay as they are,
and hide no number inside or after them; a text without finds is
unchanged; repeated rows and columns of any name are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import bind

#: The key of the registered query. Real runs pass their own.
SAMPLE_KEY = b"marketlake sample key, not a secret"
ROUNDS = 12

OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
# Years 1000 to 2999.
YEAR = "[12][0-9]{3}"
LEAP_YEAR = r"(?:[12][0-9](?:0[48]|[2468][048]|[13579][26])|(?:1[26]|2[048])00)"


def day_shape(whole: str) -> str:
    """The days of a calendar; ``whole`` puts {day}, {month} and {year} into order."""
    any_year = YEAR
    days = [
        ("(?:0[1-9]|1[0-9]|2[0-8])", "(?:0[1-9]|1[0-2])", any_year),
        ("(?:29|30)", "(?:0[13-9]|1[0-2])", any_year),
        ("31", "(?:0[13578]|1[02])", any_year),
        ("29", "02", LEAP_YEAR),
    ]
    return "(?:" + "|".join(whole.format(day=d, month=m, year=y) for d, m, y in days) + ")"


#: Checks other than those of ``START`` are part of the shape, so what fails them hides nothing.
IPV4 = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9])"
DATE = (
    rf"(?<![0-9A-Za-z-]){day_shape('{year}-{month}-{day}')}(?![0-9-])"
    + "".join(
        rf"|(?<![0-9A-Za-z./]){day_shape(order)}(?![./]?[0-9])"
        for order in ("{day}/{month}/{year}", "{month}/{day}/{year}", r"{day}\.{month}\.{year}")
    )
)
SSN = (
    r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])"
)
_IBAN = "[{0}]{{2}}[0-9]{{2}}(?:[{0}0-9]{{11,30}}|(?:\\x20[{0}0-9]{{4}}){{2,7}}(?:\\x20[{0}0-9]{{1,3}})?)"
IBAN = f"(?<![A-Za-z0-9])(?:{_IBAN.format('A-Z')}|{_IBAN.format('a-z')})(?![A-Za-z0-9])"
CARD = (
    r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:\x20[0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}"
    r"|3[47][0-9]{2}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9A-Za-z])"
)
AMERICAN = r"(?:\+?1[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
# A number abroad has 8 to 15 digits. It never runs into a card that would make it longer, and from its eighth digit on
# it ends where a number of another kind begins. In a run of groups of four, cards are the last 4, 8, 12, ... groups.
FOURS = r"[0-9]{4}(?:[\x20-][0-9]{4}){3}"
CARDS = rf"{FOURS}(?:[\x20-]{FOURS})*(?![0-9A-Za-z])(?![\x20-][0-9]{{4}}(?![0-9-]))"
OTHER_CARD = r"(?:[0-9]{14,19}|3[47][0-9]{2}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9A-Za-z])"
NEXT_CARD = rf"(?![\x20.-](?:{CARDS}|{OTHER_CARD}))"
NEXT = rf"(?![\x20.-](?:{IPV4}|{DATE}|{SSN}|{CARDS}|{OTHER_CARD}|[0-9]{{13}}(?![0-9A-Za-z])|{AMERICAN}))"
DIGIT = r"[\x20.-]?\(?[0-9]\)?"
#: As dialled within a country: a trunk zero, then three groups.
NATIONAL = r"0[1-9][0-9]{0,3}[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9A-Za-z])(?![\x20-][0-9])"
ABROAD = rf"\+[2-9][0-9](?:{NEXT_CARD}{DIGIT}){{6}}(?:{NEXT}{DIGIT}){{0,7}}(?![0-9A-Za-z])"

#: Letters of an address: ASCII, and those of the alphabets that separate words by spaces.
LETTERS = "A-Za-z0-9\u00c0-\u024f\u0370-\u1fff"
#: A domain name has at most 127 labels; nothing else is bounded.
EMAIL = (
    rf"(?<![{LETTERS}._%+-])[{LETTERS}._%+-]++@[{LETTERS}-]++(?:\.[{LETTERS}-]++){{0,125}}"
    rf"\.[{LETTERS.replace('0-9', '')}]{{2,}}+(?![{LETTERS}])"
)

#: Shapes to look at, tried in this order at each place. Spans that are found are disjoint.
SHAPES = {
    "email": EMAIL,
    "iban": IBAN,
    "ipv4": IPV4,
    "date": DATE,
    "ssn": SSN,
    "card": CARD,
    "phone": rf"(?<![0-9A-Za-z+])(?:{AMERICAN}|{ABROAD}|(?<![0-9][\x20-]){NATIONAL})",
}
#: Kinds whose check no shape can hold: texts with a span that fails it are read again, see ``exact_shape``. Their first
#: characters.
START = {"iban": "(?:[A-Z]{2}|[a-z]{2})[0-9]{2}", "card": "[0-9]{4}"}
ANY_SHAPE = "|".join(f"(?:{p})" for p in SHAPES.values())
KINDS = tuple(SHAPES)

# Days of 1900-01-01 to 2099-12-31: 200 * 365 + 49 leap days = 17 * 4297.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
# The days of 1000 to 1899 and of 2100 to 2999 move among themselves: 328,718 each, 611 * 1076 together.
BEFORE, OTHER_DAYS = 328_718, (611, 1076)


class Permutation:
    """A keyed permutation of Z_a x Z_b."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        padded = key.ljust(64, b"\0")
        if len(padded) > 64:
            raise ValueError("the key has at most 64 bytes")
        self.inner = bytes(b ^ 0x36 for b in padded)
        self.outer = bytes(b ^ 0x5C for b in padded)
        self.rounds = rounds

    def digest(self, message: Column) -> Column:
        """HMAC-SHA-256 as hex."""
        inner = F.unhex(F.sha2(F.concat(F.lit(self.inner), message.cast("binary")), 256))
        return F.sha2(F.concat(F.lit(self.outer), inner), 256)

    def __call__(self, x: Column, y: Column, a: Column, b: Column, tweak: Column) -> Column:
        """struct(x, y): even rounds move x by a function of y, odd rounds y by a function of x."""

        def value(step: Column, half: Column) -> Column:
            word = self.digest(F.concat_ws("|", tweak, step, half))
            return F.conv(F.substring(word, 1, 15), 16, 10).cast("bigint")

        def turn(state: Column, step: Column) -> Column:
            even = step % 2 == 0
            return F.struct(
                F.when(even, (state["x"] + value(step, state["y"])) % a).otherwise(state["x"]).alias("x"),
                F.when(even, state["y"]).otherwise((state["y"] + value(step, state["x"])) % b).alias("y"),
            )

        start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(self.rounds - 1)), start, turn)

    def digits(self, digits: Column, tweak: Column) -> Column:
        """A string of at most 30 digits as another one of the same length."""
        left = F.floor(F.length(digits) / 2).cast("int")
        right = F.length(digits) - left

        def power(n: Column) -> Column:
            return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")

        moved = self(
            F.coalesce(F.substr(digits, F.lit(1), left).try_cast("bigint"), F.lit(0)),
            F.coalesce(F.substr(digits, left + 1, right).try_cast("bigint"), F.lit(0)),
            power(left),
            power(right),
            tweak,
        )
        return F.when(F.length(digits) == 0, F.lit("")).otherwise(
            bind(
                moved,
                lambda m: F.concat(
                    F.lpad(m["x"].cast("string"), left, "0"), F.lpad(m["y"].cast("string"), right, "0")
                ),
            )
        )


# --- checks ----------------------------------------------------------------------------------------------------------


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    def total(bound: Column) -> Column:
        def part(at: Column) -> Column:
            digit = F.substr(bound, at, F.lit(1)).cast("int")
            twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
            return F.when((F.length(bound) - at) % 2 == 1, twice).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(bound)), F.lit(0), lambda acc, at: acc + part(at))

    return bind(digits, total)  # a lambda evaluates what it refers to at every step


def modulo_97(value: Column) -> Column:
    def step(acc: Column, char: Column) -> Column:
        return (
            F.when(char == "", acc)
            .when(char.between("0", "9"), (acc * 10 + F.ascii(char) - 48) % 97)
            .otherwise((acc * 100 + F.ascii(char) - 55) % 97)
        )

    return F.aggregate(F.split(value, ""), F.lit(0), step)


def refill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced in order."""

    def filled(bound: Column) -> Column:
        def step(state: Column, char: Column) -> Column:
            return F.when(
                (char != "") & char.between("0", "9"),
                F.struct(
                    (state["at"] + 1).alias("at"),
                    F.concat(state["out"], F.substr(bound, state["at"], F.lit(1))).alias("out"),
                ),
            ).otherwise(F.struct(state["at"].alias("at"), F.concat(state["out"], char).alias("out")))

        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
        return F.aggregate(F.split(template, ""), start, step, lambda state: state["out"])

    return bind(digits, filled)


# --- one pseudonym for each kind: NULL if the value fails its check ---------------------------------------------------


def email_pseudonym(value: Column, keyed: Permutation) -> Column:
    word = keyed.digest(F.concat(F.lit("email|"), F.lower(value)))
    return F.concat(F.lit("u"), F.substring(word, 1, 16), F.lit("@"), F.substring(word, 17, 8), F.lit(".invalid"))


def card_pseudonym(value: Column, keyed: Permutation) -> Column:
    """The first digit stays, the check digit follows."""

    def new(digits: Column) -> Column:
        first = F.substring(digits, 1, 1)
        body = F.concat(
            first,
            keyed.digits(
                F.substr(digits, F.lit(2), F.length(digits) - 2), F.concat_ws("|", F.lit("card"), F.length(digits), first)
            ),
        )

        def checked(whole: Column) -> Column:
            check = (10 - luhn_sum(F.concat(whole, F.lit("0"))) % 10) % 10
            return F.concat(whole, check.cast("string"))

        return F.when(luhn_sum(digits) % 10 == 0, bind(body, checked))

    return bind(only_digits(value), lambda d: refill(value, new(d)))


def ssn_pseudonym(value: Column, keyed: Permutation) -> Column:
    area, group, serial = (F.substring(value, at, n).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1

    def text(new: Column) -> Column:
        place = F.floor(new["x"] / 99).cast("bigint")
        return F.concat_ws(
            "-",
            F.lpad((place + 1 + F.when(place >= 665, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((new["x"] % 99 + 1).cast("string"), 2, "0"),
            F.lpad((new["y"] + 1).cast("string"), 4, "0"),
        )

    moved = keyed(rank, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"))
    return F.when(valid, bind(moved, text))


def ipv4_pseudonym(value: Column, keyed: Permutation) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("bigint"))

    def new(p: Column) -> Column:
        moved = keyed(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), F.lit("ipv4"))
        halves = ("x", "y")
        text = bind(
            moved,
            lambda m: F.concat_ws(".", *[v for h in halves for v in (F.shiftright(m[h], 8), m[h] % 256)]),
        )
        return F.when(F.forall(p, lambda v: v <= 255), text)

    return bind(parts, new)


def date_pseudonym(value: Column, keyed: Permutation) -> Column:
    """Every format is a different spelling of the same day; 12/31/2020 is read month first."""
    formats = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy")

    def new(format: str) -> Column:
        day = F.datediff(F.try_to_timestamp(value, F.lit(format)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        within = DAYS[0] * DAYS[1]

        def moved(rank: Column, domain: tuple[int, int], tweak: str, back: Callable[[Column], Column]) -> Column:
            a, b = domain
            new = keyed(rank % a, F.floor(rank / a), F.lit(a), F.lit(b), F.lit(tweak))
            first = F.lit(FIRST_DAY).cast("date")
            return bind(new, lambda m: F.date_format(F.date_add(first, back(m["y"] * a + m["x"]).cast("int")), format))

        def text(n: Column) -> Column:
            rank = F.when(n < 0, n + BEFORE).otherwise(n - within + BEFORE)
            other = moved(
                rank, OTHER_DAYS, "date|other", lambda r: F.when(r < BEFORE, r - BEFORE).otherwise(r - BEFORE + within)
            )
            return F.when(n.between(0, within - 1), moved(n, DAYS, "date", lambda r: r)).otherwise(other)

        return F.when(day.isNotNull(), bind(day, text))

    return F.coalesce(*[new(f) for f in formats])


def phone_pseudonym(value: Column, keyed: Permutation) -> Column:
    """North American numbers stay in their plan (area and exchange from 200), those written like them stay outside of
    it; others keep their first two digits, the trunk zero of a national number included."""

    def planned(area: Column, office: Column, line: Column) -> Column:
        moved = keyed(
            (area - 200) * 800 + office - 200, line, F.lit(640_000), F.lit(10_000), F.lit("phone")
        )
        return bind(
            moved,
            lambda m: F.concat(
                (F.floor(m["x"] / 800) + 200).cast("string"),
                (m["x"] % 800 + 200).cast("string"),
                F.lpad(m["y"].cast("string"), 4, "0"),
            ),
        )

    def unplanned(area: Column, office: Column, line: Column) -> Column:
        # 200 areas with 1,000 exchanges each, then 800 areas with 200 each.
        rank = F.when(area < 200, area * 1000 + office).otherwise(200_000 + (area - 200) * 200 + office)

        def text(new: Column) -> Column:
            rest = new["x"] - 200_000
            prefix = F.when(rest < 0, new["x"]).otherwise((F.floor(rest / 200) + 200) * 1000 + rest % 200)
            return F.concat(F.lpad(prefix.cast("string"), 6, "0"), F.lpad(new["y"].cast("string"), 4, "0"))

        return bind(keyed(rank, line, F.lit(360_000), F.lit(10_000), F.lit("phone|unplanned")), text)

    def american(digits: Column) -> Column:
        area, office, line = (F.substring(digits, at, n).cast("bigint") for at, n in ((1, 3), (4, 3), (7, 4)))
        return F.when((area >= 200) & (office >= 200), planned(area, office, line)).otherwise(
            unplanned(area, office, line)
        )

    def new(digits: Column) -> Column:
        n = F.length(digits)
        code = F.substring(digits, 1, 2)
        other = F.concat(code, keyed.digits(F.substr(digits, F.lit(3), n - 2), F.concat_ws("|", F.lit("phone"), n, code)))
        national = value.rlike(f"^{NATIONAL}$") & ~value.rlike(f"^{AMERICAN}$")
        return (
            F.when(value.rlike(r"^\+[2-9]"), F.when(n.between(8, 15), other))
            .when(national, other)
            .when(n == 10, american(digits))
            .otherwise(F.concat(F.lit("1"), american(F.substr(digits, F.lit(2), F.lit(10)))))
        )

    return bind(only_digits(value), lambda d: refill(value, new(d)))


def iban_pseudonym(value: Column, keyed: Permutation) -> Column:
    """Country and letters stay, digits of the account move, check digits follow. Letters may be small."""

    def new(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5), F.length(plain) - 4)
        valid = modulo_97(F.concat(account, F.substring(plain, 1, 4))) == 1
        shape = F.regexp_replace(account, "[0-9]", "#")
        moved = refill(account, keyed.digits(only_digits(account), F.concat_ws("|", F.lit("iban"), country, shape)))

        def whole(body: Column) -> Column:
            check = F.lpad((98 - modulo_97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
            return refill(value, only_digits(F.concat(check, body)))

        return F.when(valid, bind(moved, whole))

    return bind(F.upper(F.replace(value, F.lit(" "), F.lit(""))), new)


PSEUDONYMS = {
    "email": email_pseudonym,
    "iban": iban_pseudonym,
    "ipv4": ipv4_pseudonym,
    "date": date_pseudonym,
    "ssn": ssn_pseudonym,
    "card": card_pseudonym,
    "phone": phone_pseudonym,
}


def is_card(value: Column) -> Column:
    return bind(only_digits(value), lambda d: luhn_sum(d) % 10 == 0)


def is_iban(value: Column) -> Column:
    plain = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    return bind(plain, lambda p: modulo_97(F.concat(F.substr(p, F.lit(5), F.length(p) - 4), F.substring(p, 1, 4))) == 1)


def exact_shape(content: Column) -> Column:
    """``ANY_SHAPE`` with the IBANs and cards that pass their check in place of their shapes.

    Candidates are taken at every place, inside of others too, and a spaced IBAN may end at each of its groups, so what
    fails a check hides nothing. At one place the longest value that passes is taken.
    """

    def everywhere(kind: str) -> Column:
        return F.array_distinct(F.regexp_extract_all(content, F.lit(f"(?=({SHAPES[kind]}))"), F.lit(1)))

    def shorter(value: Column) -> Column:
        groups = F.split(value, " ")
        ends = F.when(F.size(groups) > 3, F.sequence(F.lit(3), F.size(groups))).otherwise(F.array(F.size(groups)))
        return F.transform(ends, lambda n: F.array_join(F.slice(groups, 1, n), " "))

    def among(kind: str, values: Column) -> Column:
        longest_first = F.transform(
            F.sort_array(F.transform(values, lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))), asc=False),
            lambda s: s["v"],
        )
        listed = F.concat(
            F.lit(rf"(?<![A-Za-z0-9])(?={START[kind]})(?:"), F.array_join(longest_first, "|"), F.lit(r")(?![A-Za-z0-9])")
        )
        return F.when(F.size(values) > 0, listed).otherwise(F.lit("(?!)"))

    ibans = F.filter(F.array_distinct(F.flatten(F.transform(everywhere("iban"), shorter))), is_iban)
    cards = F.filter(everywhere("card"), is_card)
    shapes = {k: F.lit(s) for k, s in SHAPES.items()}
    shapes |= {"iban": bind(ibans, lambda v: among("iban", v)), "card": bind(cards, lambda v: among("card", v))}
    return F.concat_ws("|", *[F.concat(F.lit("(?:"), s, F.lit(")")) for s in shapes.values()])


def pseudonymize(docs: DataFrame, text: str = "text", key: bytes = SAMPLE_KEY) -> DataFrame:
    """``docs`` with ``text`` replaced and ``pii`` added: (kind, pseudonym) of each find, in order."""
    keyed = Permutation(key)
    content = F.col(text)

    def find(kind: str, new: Column) -> Column:
        return bind(new, lambda n: F.when(n.isNotNull(), F.struct(F.lit(kind).alias("kind"), n.alias("new"))))

    def one(value: Column) -> Column:
        finds = F.lit(None).cast("struct<kind:string,new:string>")
        for kind in reversed(KINDS):
            found = find(kind, PSEUDONYMS[kind](value, keyed))
            finds = F.when(value.rlike(f"^(?:{SHAPES[kind]})$"), found).otherwise(finds)
        return F.struct(value.alias("old"), finds.alias("find"))

    def fails(value: Column) -> Column:
        return (value.rlike(f"^(?:{SHAPES['iban']})$") & ~is_iban(value)) | (
            value.rlike(f"^(?:{SHAPES['card']})$") & ~is_card(value)
        )

    def spans(shape: Column) -> Column:
        """The texts between the finds, and the finds."""
        return F.struct(
            F.split(content, shape, -1).alias("rest"),
            F.transform(F.regexp_extract_all(content, shape, F.lit(0)), one).alias("found"),
        )

    none = F.array().cast("array<struct<old:string,find:struct<kind:string,new:string>>>")
    values = F.regexp_extract_all(content, F.lit(ANY_SHAPE), F.lit(0))
    exact = F.when(F.exists(values, fails), exact_shape(content)).otherwise(F.lit(ANY_SHAPE))
    found = F.when(content.rlike(ANY_SHAPE), bind(exact, spans))

    def spliced(finds: Column) -> Column:
        news = F.transform(finds["found"], lambda f: F.coalesce(f["find"]["new"], f["old"]))
        return F.array_join(
            F.flatten(F.zip_with(finds["rest"], news, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))),
            "",
        )

    names = [c for c in docs.columns if c != "pii"]
    found_col = "finds"
    while found_col in names:
        found_col += "_"
    return docs.select(*[F.col(f"`{c}`") for c in names], found.alias(found_col)).select(
        *[
            F.when(F.size(F.col(found_col)["found"]) > 0, spliced(F.col(found_col))).otherwise(content).alias(text)
            if c == text
            else F.col(f"`{c}`")
            for c in names
        ],
        F.transform(
            F.filter(F.coalesce(F.col(found_col)["found"], none), lambda f: f["find"].isNotNull()), lambda f: f["find"]
        ).alias("pii"),
    )


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: the text with pseudonyms, and the number of finds of each kind."""

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return pseudonymize(docs.select("doc_id", "text")).select("doc_id", "text", *[count(k) for k in KINDS])
