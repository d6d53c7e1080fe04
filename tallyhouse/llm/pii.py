"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

Found and validated: e-mail addresses, IPv4 addresses (octets up to 255), payment cards (12 to
19 digits with a valid check digit), IBANs (valid modulo 97; of their country's length, or of any
if the country or the length is another), US social security numbers (areas, groups and serials in
use), dates that exist, and telephone numbers (an international or a North American form, with
brackets or without). Dates are ISO dates, year, month, day with other marks, and day and month in
either order before a year of four digits, with slashes also of two, with full stops of two if day
and month have two digits. Each is replaced by another valid value of its own format:
separators stay, the digits of a kind are permuted within the numbers that are valid for it,
and check digits are computed anew. The permutation depends on the key alone, so equal values
have equal pseudonyms in all documents, different ones stay different, and the holder of the key
can turn them back (``revert=True``).

Permutation: a value is a pair (left, right) below (a, b), where a * b counts the valid values.
Each of ten rounds adds a keyed hash of one half to the other, modulo its bound. Dates are days
of a 400-year cycle, which has 189 * 773 days whatever its start; years of two digits count as one
century of 75 * 487 days. Where the form allows only some days (one digit; a day that could be a
month), the permutation is applied until it gives such a day. What a permutation must leave
as it is (the country code, the mail domain, an IBAN's country) is also hashed into the rounds.

Everything is DataFrame functions; documents without a digit or @ are passed on at once.

Defined cases: NULL stays NULL and empty stays empty; what fails validation stays as it is;
dates before 1800 or after 2199 and dates with a month's name stay; North American numbers with
spaces alone count if area and office begin with 2 to 9; other columns and repeated rows are untouched.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)+"
_IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
#: Countries by the length of their IBANs.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}(?!\w)"


_IBAN = (
    rf"(?<!\w)(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join(_iban_of(*item) for item in _IBAN_LENGTHS.items())}"
    r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
)
_PHONE = (
    r"(?<![\w+])\+(?:1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
    r"|\d{1,3}(?:[ .-](?:\(\d{1,4}\)|\d{1,4})){2,5}(?!\w|\.\d)|\d{8,15}(?!\w))"
)
_LOCAL = r"(?<![\w(])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\w)"
_BARE = (
    r"(?<![\w+])(?<!\d[-.])(?:1[-. ])?"
    r"(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|[2-9]\d{2} [2-9]\d{2}[ -]\d{4})(?!\w|[-.]\d)"
)
_DAY = (
    r"(?<!\w)(?<!\d[-./])(?:\d{4}(?:-\d{1,2}-|\.\d{1,2}\.|/\d{1,2}/)\d{1,2}"
    r"|\d{1,2}(?:-\d{1,2}-|\.\d{1,2}\.|/\d{1,2}/)\d{4}|\d{1,2}/\d{1,2}/\d{2}|\d{2}\.\d{2}\.\d{2})"
    r"(?:(?=T\d{2}:)|(?!\w|[-./]\d))"
)
_CARD = r"(?<![\w-])(?:\d{12,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\w)"
FOUND = "|".join([_EMAIL, _IPV4, _DATE, _SSN, _IBAN, _PHONE, _LOCAL, _BARE, _CARD, _DAY])
_FIRST_DAY = "1800-01-01"
_CYCLE = (189, 773)
_FIRST_OF_CENTURY = "2000-01-01"
_CENTURY = (75, 487)
#: Of all days one in five at least is allowed, so that a walk this long ends but once in 10^19.
_LONGEST_WALK = 200


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _long(digits: Column) -> Column:
    return F.coalesce(digits.cast("long"), F.lit(0).cast("long"))


class Feistel:
    """``key``: the secret; ``revert``: turn pseudonyms back."""

    def __init__(self, key: str, revert: bool = False):
        self.key, self.revert = key, revert

    def _hash(self, tweak: Column, turn: Column, half: Column) -> Column:
        said = F.concat_ws("|", F.lit(self.key), tweak, turn.cast("string"), half.cast("string"))
        digest = F.substring(F.sha2(said.cast("binary"), 256), 1, 15)
        return F.conv(digest, 16, 10).cast("long")

    def permuted(self, left: Column, right: Column, a: Column, b: Column, tweak: Column) -> Column:
        """A struct (l, r) with l < a and r < b."""
        turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        if self.revert:
            turns = F.reverse(turns)
        sign = -1 if self.revert else 1

        def one_round(pair: Column, turn: Column) -> Column:
            l, r = pair["l"], pair["r"]
            even = turn % 2 == 0
            added = self._hash(tweak, turn, F.when(even, r).otherwise(l))
            return F.struct(
                F.when(even, F.pmod(l + sign * (added % a), a)).otherwise(l).alias("l"),
                F.when(even, r).otherwise(F.pmod(r + sign * (added % b), b)).alias("r"),
            )

        start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
        return F.aggregate(turns, start, one_round)

    def value(self, number: Column, a: int, b: int, tweak: Column) -> Column:
        """A number below a * b."""
        pair = self.permuted(
            F.floor(number / F.lit(b)).cast("long"),
            F.pmod(number, F.lit(b).cast("long")),
            F.lit(a).cast("long"),
            F.lit(b).cast("long"),
            tweak,
        )
        return pair["l"] * b + pair["r"]

    def digits(self, digits: Column, tweak: Column) -> Column:
        """As many digits as there were, any of them."""
        n = F.length(digits)
        split = F.floor(n / 2).cast("int")
        pair = self.permuted(
            _long(digits.substr(F.lit(1), split)),
            _long(digits.substr(split + 1, n)),
            _power(split),
            _power(n - split),
            F.concat_ws("|", tweak, n.cast("string")),
        )
        left = F.when(split > 0, F.lpad(pair["l"].cast("string"), split, "0")).otherwise("")
        return F.concat(left, F.lpad(pair["r"].cast("string"), n - split, "0"))

    def letters(self, word: Column, tweak: Column) -> Column:
        """As many letters a to z as there were; at most 22, so that halves stay exact as doubles."""
        n = F.length(word)
        split = F.floor(n / 2).cast("int")
        pair = self.permuted(
            _from_letters(word.substr(F.lit(1), split)),
            _from_letters(word.substr(split + 1, n)),
            _power(split, 26),
            _power(n - split, 26),
            F.concat_ws("|", tweak, n.cast("string")),
        )
        return F.concat(_to_letters(pair["l"], split), _to_letters(pair["r"], n - split))


def _power(n: Column, base: int = 10) -> Column:
    powers = range(17 if base == 10 else 13)
    return F.element_at(F.array(*[F.lit(base**k).cast("long") for k in powers]), n + 1)


def _from_letters(word: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(F.split(word, ""), zero, lambda v, c: F.when(c == "", v).otherwise(v * 26 + F.ascii(c) - 97))


def _to_letters(number: Column, n: Column) -> Column:
    def letter(k: Column) -> Column:
        return F.char(F.floor(number / _power(k, 26)) % 26 + 97)

    places = F.reverse(F.sequence(F.lit(0), n - 1))
    return F.when(n > 0, F.array_join(F.transform(places, letter), "")).otherwise("")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _filled(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced in turn by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def one(done: Column, c: Column) -> Column:
        digit = c.rlike(r"^\d$")
        return F.struct(
            F.concat(done["out"], F.when(digit, digits.substr(done["at"], F.lit(1))).otherwise(c)).alias("out"),
            (done["at"] + digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(pattern, ""), start, one, lambda done: done["out"])


def _luhn_sum(digits: Column) -> Column:
    """Of digits whose last is not doubled."""
    def one(done: Column, c: Column) -> Column:
        d = c.cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.struct(
            (done["sum"] + F.when(done["odd"], doubled).otherwise(d)).alias("sum"), (~done["odd"]).alias("odd")
        )

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(each, start, one, lambda done: done["sum"])


def _mod97(text: Column) -> Column:
    """Of letters and digits, a letter counting as its two-digit number from A = 10 on."""
    def one(rest: Column, c: Column) -> Column:
        letter = c.rlike("^[A-Z]$")
        two = (rest * 100 + F.ascii(c) - 55) % 97
        return F.when(c == "", rest).when(letter, two).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), one)


def _card(f: Feistel, value: Column) -> Column:
    """All digits but the last are permuted; 10 to the 12th bounds a half, so 19 digits fit."""
    digits = _only_digits(value)
    moved = f.digits(digits.substr(F.lit(1), F.length(digits) - 1), F.lit("card"))
    check = F.pmod(-_luhn_sum(F.concat(moved, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn_sum(digits) % 10 == 0, _filled(value, F.concat(moved, check)))


def _date(f: Feistel, value: Column) -> Column:
    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit(_FIRST_DAY).cast("date")).cast("long")
    known = (day >= 0) & (day < _CYCLE[0] * _CYCLE[1])
    moved = F.date_add(F.lit(_FIRST_DAY).cast("date"), f.value(day, *_CYCLE, F.lit("date")).cast("int"))
    return F.when(known, F.date_format(moved, "yyyy-MM-dd"))


def _day(f: Feistel, value: Column) -> Column:
    """Fields keep their length; a day that could be a month becomes another such one."""
    one, two, three = (F.get(F.split(value, "[-./]"), i) for i in range(3))
    year_first = F.length(one) == 4
    first, second = F.when(year_first, two).otherwise(one), F.when(year_first, three).otherwise(two)
    day_first = ~year_first & (first.cast("int") > 12)
    fields = F.struct(
        year_first.alias("year_first"),
        day_first.alias("day_first"),
        ((first.cast("int") <= 12) & (second.cast("int") <= 12)).alias("either"),
        F.when(year_first, one).otherwise(three).alias("year"),
        F.when(day_first, second).otherwise(first).alias("month"),
        F.when(day_first, first).otherwise(second).alias("day"),
    )

    def known(x: Column) -> Column:
        full = F.length(x["year"]) == 4
        start = F.when(full, F.lit(_FIRST_DAY)).otherwise(F.lit(_FIRST_OF_CENTURY)).cast("date")
        year = F.when(full, x["year"]).otherwise(F.concat(F.lit("20"), x["year"]))
        said = F.concat_ws("-", year, F.lpad(x["month"], 2, "0"), F.lpad(x["day"], 2, "0"))
        return F.struct(
            x["year_first"].alias("year_first"),
            x["day_first"].alias("day_first"),
            x["either"].alias("either"),
            F.length(x["year"]).alias("year"),
            F.length(x["month"]).alias("month"),
            F.length(x["day"]).alias("day"),
            start.alias("start"),
            F.when(full, _CYCLE[0]).otherwise(_CENTURY[0]).cast("long").alias("a"),
            F.when(full, _CYCLE[1]).otherwise(_CENTURY[1]).cast("long").alias("b"),
            F.datediff(F.try_to_date(said, "yyyy-MM-dd"), start).cast("long").alias("n"),
        )

    def walked(x: Column) -> Column:
        def once(n: Column) -> Column:
            left, right = F.floor(n / x["b"]).cast("long"), n % x["b"]
            pair = f.permuted(left, right, x["a"], x["b"], F.lit("date"))
            return _let(pair, lambda moved: moved["l"] * x["b"] + moved["r"])

        def fits(n: Column) -> Column:
            date = F.date_add(x["start"], n.cast("int"))
            short = ((x["day"] == 2) | (F.dayofmonth(date) < 10)) & ((x["month"] == 2) | (F.month(date) < 10))
            return short & (x["year_first"] | ((F.dayofmonth(date) <= 12) == x["either"]))

        steps = F.sequence(F.lit(1), F.lit(_LONGEST_WALK))
        moved = F.aggregate(steps, once(x["n"]), lambda n, _: F.when(fits(n), n).otherwise(once(n)))
        return _let(F.date_add(x["start"], moved.cast("int")), lambda date: written(x, date))

    def written(x: Column, date: Column) -> Column:
        year = F.right(F.date_format(date, "yyyy"), x["year"])
        day = F.lpad(F.dayofmonth(date).cast("string"), x["day"], "0")
        month = F.lpad(F.month(date).cast("string"), x["month"], "0")
        digits = F.when(x["year_first"], F.concat(year, month, day))
        return digits.when(x["day_first"], F.concat(day, month, year)).otherwise(F.concat(month, day, year))

    def moved(x: Column) -> Column:
        return F.when((x["n"] >= 0) & (x["n"] < x["a"] * x["b"]), walked(x))

    digits = _let(fields, lambda x: _let(known(x), moved))
    return _let(digits, lambda d: F.when(d.isNotNull(), _filled(value, d)))


def _ssn(f: Feistel, value: Column) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001."""
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    in_use = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    dense = area - F.when(area > 666, 2).otherwise(1)
    pair = f.permuted(
        dense * 99 + group - 1, serial - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), F.lit("ssn")
    )
    dense = F.floor(pair["l"] / 99) + 1
    area = dense + F.when(dense >= 666, 1).otherwise(0)
    parts = [(area, 3), (pair["l"] % 99 + 1, 2), (pair["r"] + 1, 4)]
    return F.when(in_use, F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in parts]))


def _ipv4(f: Feistel, value: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    valid = F.forall(octets, lambda o: o < 256)
    halves = [F.get(octets, i) * 256 + F.get(octets, i + 1) for i in (0, 2)]
    bound = F.lit(65536).cast("long")
    pair = f.permuted(*halves, bound, bound, F.lit("ipv4"))
    parts = [F.floor(h / 256) if top else h % 256 for h in (pair["l"], pair["r"]) for top in (True, False)]
    return F.when(valid, F.concat_ws(".", *[p.cast("string") for p in parts]))


def _iban(f: Feistel, value: Column) -> Column:
    """The digits behind the check digits are permuted; letters and country stay."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    bban = plain.substr(F.lit(5), F.length(plain))
    country = plain.substr(1, 2)
    valid = _mod97(F.concat(bban, plain.substr(1, 4))) == 1
    digits = _only_digits(bban)
    moved = F.when(F.length(digits) > 0, f.digits(digits, F.concat(F.lit("iban"), country))).otherwise("")
    filled = _filled(bban, moved)
    check = 98 - _mod97(F.concat(filled, country, F.lit("00")))
    return F.when(valid, _filled(value, F.concat(F.lpad(check.cast("string"), 2, "0"), moved)))


def _phone(f: Feistel, value: Column) -> Column:
    """All digits behind a country code.

    A North American number keeps to areas and offices from 200 on, or to the others if it is of those.
    """
    code = F.regexp_extract(value, r"^\+(\d{1,3})(?=[ .(-])", 1)
    code = F.when(value.rlike("^1[-. ]"), F.lit("1")).otherwise(code)
    code = F.when(value.startswith("+") & (code == ""), value.substr(2, 2)).otherwise(code)
    digits = _only_digits(value)
    rest = digits.substr(F.length(code) + 1, F.length(digits))
    tweak = F.concat(F.lit("phone"), code)
    area, office, line = (rest.substr(i, n).cast("long") for i, n in ((1, 3), (4, 3), (7, 4)))
    # The 640,000 prefixes in the plan, and the others: 200 areas below 200, then 800 of 200 offices.
    planned = (area >= 200) & (office >= 200)
    dense = F.when(planned, (area - 200) * 800 + office - 200).when(area < 200, area * 1000 + office)
    dense = dense.otherwise(200000 + (area - 200) * 200 + office) * 10000 + line
    side = F.when(planned, 80000).otherwise(60000).cast("long")
    pair = f.permuted(F.floor(dense / side).cast("long"), dense % side, side, side, tweak)

    def plan_digits(moved: Column) -> Column:
        nth, last = F.floor(moved["n"] / 10000), moved["n"] % 10000
        prefix = F.when(moved["planned"], (F.floor(nth / 800) + 200) * 1000 + nth % 800 + 200)
        prefix = prefix.when(nth < 200000, nth).otherwise((F.floor(nth / 200) - 800) * 1000 + nth % 200)
        return F.concat(F.lpad(prefix.cast("string"), 6, "0"), F.lpad(last.cast("string"), 4, "0"))

    number = _let(pair, lambda moved: moved["l"] * side + moved["r"])
    american = _let(F.struct(number.alias("n"), planned.alias("planned")), plan_digits)
    is_american = code.isin("", "1") & (F.length(rest) == 10)
    return _filled(value, F.concat(code, F.when(is_american, american).otherwise(f.digits(rest, tweak))))


def _email(f: Feistel, value: Column) -> Column:
    """Runs of letters become other letters in lower case, runs of digits other digits."""
    at = F.locate("@", value)
    domain = F.lower(value.substr(at, F.length(value)))
    local = F.lower(value.substr(F.lit(1), at - 1))
    runs = F.regexp_extract_all(local, F.lit(r"[a-z]{1,22}|[0-9]{1,24}|[^a-z0-9]"), F.lit(0))
    tweak = F.concat(F.lit("mail"), domain)

    def moved(run: Column) -> Column:
        return (
            F.when(run.rlike("^[a-z]"), f.letters(run, tweak))
            .when(run.rlike("^[0-9]"), f.digits(run, tweak))
            .otherwise(run)
        )

    return F.concat(F.array_join(F.transform(runs, moved), ""), domain)


_KINDS = [
    (_EMAIL, _email),
    (_IPV4, _ipv4),
    (_DATE, _date),
    (_SSN, _ssn),
    (_IBAN, _iban),
    (_CARD, _card),
    (_PHONE, _phone),
    (_LOCAL, _phone),
    (_BARE, _phone),
    (_DAY, _day),
]


def pseudonymised(docs: DataFrame, key: str, revert: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and their number in ``n_replaced``."""
    f = Feistel(key, revert)
    text = F.col("text")

    def replaced(value: Column) -> Column:
        new = None
        for pattern, move in _KINDS:
            fits = value.rlike(_whole(pattern))
            new = F.when(fits, move(f, value)) if new is None else new.when(fits, move(f, value))
        return F.coalesce(new.otherwise(F.lit(None)), value)

    worth = text.rlike("[0-9@]")
    found = F.when(worth, F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)))
    rows = docs.drop("n_replaced").withColumn("_found", found)
    rows = rows.withColumn("_new", F.when(F.size("_found") > 0, F.transform("_found", replaced)))
    between = F.split(text, FOUND, -1)
    whole = F.concat(
        F.array_join(F.zip_with(F.slice(between, 1, F.size("_new")), "_new", lambda p, n: F.concat(p, n)), ""),
        F.element_at(between, -1),
    )
    changed = F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x))
    return rows.withColumns(
        {
            "text": F.when(F.col("_new").isNotNull(), whole).otherwise(text),
            "n_replaced": F.when(F.col("_new").isNotNull(), changed).otherwise(0).cast("long"),
        }
    ).drop("_found", "_new")
