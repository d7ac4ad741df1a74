"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

Values are found by pattern and validated; each is replaced by a keyed
permutation of itself within its own format, so the pseudonym validates again,
equal values get equal pseudonyms in all documents, and different values get
different ones. Everything is a built-in column expression, row by row: no
Python runs, and nothing is shuffled.

===========  ==============================  ==================================
kind         valid if                        what is permuted
===========  ==============================  ==================================
card         known first digits, Luhn        all but the first two digits; the
                                             check digit is computed anew
iban         check digits (mod 97)           the account's digits; check digits
                                             are computed anew
ssn          issued area, group, serial      area x (group, serial)
ipv4         four octets without 0-prefix    all four octets
phone        +country and 8-15 digits, or    digits after the country code (two
             a national 10-digit number      digits, or 1); area x rest
date         a day of 1900-2099              the day, by cycle walking
email        local@host.tld                  letters and digits of the local
                                             part, each within its class
credential   token/secret/password/key =     letters and digits, each within
             16 or more characters           its class (long ones in pieces)
===========  ==============================  ==================================

A finding ends where its kind ends: an IBAN at its country's length, a phone after 15
digits at most and before a date. A number with country code 1 has ten digits; with
other codes the groups of two or more digits that follow belong to it, since nothing
tells them from a count. What is named as a credential is permuted as one, whatever
it looks like.

Left alone: anything that does not validate (16 digits that fail the Luhn test,
version numbers of three parts, days outside 1900-2099).

Defined results: a null text stays null and counts as no finding; an empty text
stays empty. Texts are processed whole. Repeated rows get equal results. Other
columns pass through, also where they are named like a result column (the result
replaces them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
#: Set around findings; two code points that are no characters.
MARK = "\ufdd0\ufdd1"
#: Between a finding's first group (what a credential holds) and the finding.
FLAG = "\ufdd2"
#: Characters of a credential that are permuted together.
CREDENTIAL_PIECE = 256
KEY = "basketseq"

# The length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """By country first; other countries by groups, and the check digits decide."""
    by_length = [
        f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{length // 4 - 1}}}"
        + (f" ?[A-Z0-9]{{{length % 4}}}" if length % 4 else "")
        for length, countries in IBAN_LENGTHS.items()
    ]
    other = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*by_length, other])})(?![A-Za-z0-9])"


_DATE = r"(?:[0-9]{4}[\-/.][0-9]{2}[\-/.][0-9]{2}|[0-9]{2}[\-/.][0-9]{2}[\-/.][0-9]{4})"
# The order counts: of two patterns at one place the earlier one wins.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}+"
    r"@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    # The only group with a number: it tells a credential from its look-alikes.
    "credential": r"(?<![A-Za-z0-9_\-.+/])(?=[A-Za-z0-9_\-.+/]{16})"
    r"(?<=(?i:token|secret|password|passwd|api[_-]?key)[ \t]{0,4}[=:][ \t]{0,4}[\"']?)"
    r"([A-Za-z0-9_\-.+/]{15,}[A-Za-z0-9_\-+/]={0,2})",
    "iban": _iban_pattern(),
    "date": rf"(?<![0-9])(?<![0-9][.\-/]){_DATE}(?![0-9]|[.\-/][0-9])",
    "ipv4": r"(?<![0-9])(?<![0-9][.])(?:[0-9]{1,3}[.]){3}[0-9]{1,3}(?![0-9]|[.][0-9])",
    "card": r"(?<![0-9])(?<![0-9][.])(?:[0-9]{13,19}"
    r"|[0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}"
    r"|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9]|[.][0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}"
    # At most 15 digits; a blank is followed by no date and by no lone digit.
    rf"|\+[0-9](?:(?: \(?(?!{_DATE})(?=[0-9]{{2}}|[0-9][ .\-][0-9]{{2}})|[.\-]|\)[ .\-]?|\()?[0-9]){{7,14}}"
    r"|(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.\-])[2-9][0-9]{2}[.\-][0-9]{4})(?![0-9])",
}
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())

CARD_START = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[0-9])"
FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31
DATE_SIDES = (271, 270)  # the smallest near-square that holds all days
DATE_FORMATS = {
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$": ("yyyy-MM-dd", ""),
    r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$": ("yyyy/MM/dd", ""),
    r"^[0-9]{4}[.][0-9]{2}[.][0-9]{2}$": ("yyyy.MM.dd", ""),
    # Where the middle is no month it is a day; both readings stay apart.
    r"^[0-9]{2}/(?:0[1-9]|1[0-2])/[0-9]{4}$": ("dd/MM/yyyy", ""),
    r"^[0-9]{2}/[1-3][0-9]/[0-9]{4}$": ("MM/dd/yyyy", "late"),
    r"^[0-9]{2}-(?:0[1-9]|1[0-2])-[0-9]{4}$": ("dd-MM-yyyy", ""),
    r"^[0-9]{2}-[1-3][0-9]-[0-9]{4}$": ("MM-dd-yyyy", "late"),
    r"^[0-9]{2}[.][0-9]{2}[.][0-9]{4}$": ("dd.MM.yyyy", ""),
}
WALK = 200


def _call(name: str, *columns: Column) -> Column:
    return F.call_function(name, *columns)


def _hash(key: str, *parts: Column) -> Column:
    """60 keyed bits of the parts."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(key: str, tweak: Column, left: Column, right: Column, a: Column, b: Column) -> Column:
    """A permutation of pairs (left in [0, a), right in [0, b)), as a struct (l, r)."""

    def half(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]
        return F.struct(
            F.when(i % 2 == 1, (l + _hash(key, tweak, i, r)) % a).otherwise(l).alias("l"),
            F.when(i % 2 == 0, (r + _hash(key, tweak, i, l)) % b).otherwise(r).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, half)


def _long(text: Column) -> Column:
    return F.coalesce(text.try_cast("long"), F.lit(0).cast("long"))


def _power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permuted_digits(key: str, tweak: Column, digits: Column) -> Column:
    """Digits to as many digits (up to 36 of them)."""
    n = F.length(digits)
    h = _call("div", n, F.lit(2)).cast("int")
    after = feistel(
        key,
        F.concat_ws("|", tweak, n.cast("string")),
        _long(digits.substr(F.lit(1), h)),
        _long(digits.substr(h + 1, n)),
        _power_of_ten(h),
        _power_of_ten(n - h),
    )
    return _let(
        after,
        lambda s: F.concat(
            F.lpad(s["l"].cast("string"), h, F.lit("0")),
            F.lpad(s["r"].cast("string"), n - h, F.lit("0")),
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _positions(value: Column) -> Column:
    return F.sequence(F.lit(1), F.length(value))


def _laid_out(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in turn by ``digits``."""

    def place(i: Column) -> Column:
        old = value.substr(i, F.lit(1))
        nth = F.length(_digits(value.substr(F.lit(1), i)))
        return F.when(old.rlike("[0-9]"), digits.substr(nth, F.lit(1))).otherwise(old)

    return F.array_join(F.transform(_positions(value), place), "")


def permuted_characters(key: str, tweak: Column, value: Column) -> Column:
    """Digits, small and capital letters move within their class; the rest stays.

    A Feistel network over the two halves of the text: in each round one half is
    shifted, character by character, by hashes of the other.
    """

    def shifted(half: Column, other: Column, i: Column) -> Column:
        def shift(j: Column) -> Column:
            c = half.substr(j, F.lit(1))
            size = F.when(c.rlike("[0-9]"), 10).otherwise(26)
            base = F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).otherwise(65)
            moved = (F.ascii(c) - base + _hash(key, tweak, i, j, F.length(half), other)) % size
            return F.when(c.rlike("[A-Za-z0-9]"), F.chr(moved + base)).otherwise(c)

        parts = F.transform(_positions(half), shift)
        return F.when(F.length(half) == 0, half).otherwise(F.array_join(parts, ""))

    def step(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]
        return F.struct(
            F.when(i % 2 == 1, shifted(l, r, i)).otherwise(l).alias("l"),
            F.when(i % 2 == 0, shifted(r, l, i)).otherwise(r).alias("r"),
        )

    h = _call("div", F.length(value), F.lit(2)).cast("int")
    start = F.struct(
        value.substr(F.lit(1), h).alias("l"), value.substr(h + 1, F.length(value)).alias("r")
    )
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda s: F.concat(s["l"], s["r"]))


def _card(key: str, value: Column) -> Column:
    digits = _digits(value)

    def with_check(payload: Column) -> Column:
        ten = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(payload, c.cast("string")))
        return F.element_at(F.filter(ten, lambda d: _call("luhn_check", d)), 1)

    start = digits.substr(1, 2)
    middle = digits.substr(F.lit(3), F.length(digits) - 3)
    fresh = with_check(F.concat(start, permuted_digits(key, F.concat(F.lit("card"), start), middle)))
    valid = digits.rlike(CARD_START) & _call("luhn_check", digits)
    return F.when(valid, _laid_out(value, fresh)).otherwise(value)


def _mod_97(text: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        c = text.substr(i, F.lit(1))
        letter = (total * 100 + F.ascii(c) - 55) % 97
        return F.when(c.rlike("[0-9]"), (total * 10 + F.ascii(c) - 48) % 97).otherwise(letter)

    return F.aggregate(_positions(text), F.lit(0), add)


def _iban(key: str, value: Column) -> Column:
    solid = F.regexp_replace(value, " ", "")
    country, check = solid.substr(1, 2), solid.substr(3, 2)
    account = solid.substr(F.lit(5), F.length(solid))

    def check_digits(bban: Column) -> Column:
        rest = _mod_97(F.concat(bban, country, F.lit("00")))
        return F.lpad((F.lit(98) - rest).cast("string"), 2, "0")

    letters = F.regexp_replace(account, "[0-9]", "0")
    digits = _digits(account)
    fresh = permuted_digits(key, F.concat(F.lit("iban"), country, letters), digits)
    renewed = _let(
        _laid_out(account, fresh),
        lambda bban: _laid_out(value, F.concat(check_digits(bban), _digits(bban))),
    )
    return F.when(
        (check_digits(account) == check) & (F.length(digits) > 0), renewed
    ).otherwise(value)


def _ssn(key: str, value: Column) -> Column:
    area, group, serial = (_long(F.split_part(value, F.lit("-"), F.lit(i))) for i in (1, 2, 3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    rest = (group - 1) * 9999 + serial - 1
    after = feistel(key, F.lit("ssn"), place, rest, F.lit(898), F.lit(99 * 9999))
    number = lambda s: F.format_string(
        "%03d-%02d-%04d",
        F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1),
        _call("div", s["r"], F.lit(9999)) + 1,
        s["r"] % 9999 + 1,
    )
    return F.when(valid, _let(after, number)).otherwise(value)


def _ipv4(key: str, value: Column) -> Column:
    octet = [_long(F.split_part(value, F.lit("."), F.lit(i))) for i in (1, 2, 3, 4)]
    valid = (F.greatest(*octet) < 256) & ~value.rlike(r"(?:^|[.])0[0-9]")
    after = feistel(
        key,
        F.lit("ipv4"),
        octet[0] * 256 + octet[1],
        octet[2] * 256 + octet[3],
        F.lit(65536),
        F.lit(65536),
    )
    dotted = lambda s: F.concat_ws(
        ".",
        _call("div", s["l"], F.lit(256)).cast("string"),
        (s["l"] % 256).cast("string"),
        _call("div", s["r"], F.lit(256)).cast("string"),
        (s["r"] % 256).cast("string"),
    )
    return F.when(valid, _let(after, dotted)).otherwise(value)


def _phone(key: str, value: Column) -> Column:
    digits = _digits(value)
    known = F.when(digits.startswith("1"), 1).otherwise(2)
    rest = digits.substr(known + 1, F.length(digits))
    code = digits.substr(F.lit(1), known)
    abroad = F.concat(code, permuted_digits(key, F.concat(F.lit("phone"), code), rest))
    # National: area and exchange start at 200; 800 x (800 x 10000) numbers.
    area, exchange, line = (_long(digits.substr(i, n)) for i, n in ((1, 3), (4, 3), (7, 4)))
    after = feistel(
        key,
        F.lit("national"),
        area - 200,
        (exchange - 200) * 10_000 + line,
        F.lit(800),
        F.lit(8_000_000),
    )
    at_home = _let(
        after,
        lambda s: F.format_string("%03d%07d", s["l"] + 200, s["r"] + 2_000_000),
    )
    return (
        F.when(
            value.startswith("+") & F.length(digits).between(8, 15), _laid_out(value, abroad)
        )
        .when(~value.startswith("+"), _laid_out(value, at_home))
        .otherwise(value)
    )


def _date(key: str, value: Column) -> Column:
    a, b = DATE_SIDES
    epoch = F.lit(FIRST_DAY).cast("date")
    # Which layout, by its place in the list; the first that fits.
    layout = F.coalesce(
        *(F.when(value.rlike(pattern), n) for n, pattern in enumerate(DATE_FORMATS))
    )
    layouts = list(enumerate(DATE_FORMATS.values()))

    def chosen(of) -> Column:
        return F.coalesce(*(F.when(layout == n, of(*form)) for n, form in layouts))

    late = chosen(lambda _, kind: F.lit(kind == "late"))
    tweak = F.when(late, F.lit("late")).otherwise(F.lit("date"))

    def step(at: Column, i: Column) -> Column:
        """The day moved once, and again while it has left its domain."""
        day = _call("div", at, F.lit(b)), at % b
        moved = _let(
            feistel(key, tweak, *day, F.lit(a), F.lit(b)), lambda s: s["l"] * b + s["r"]
        )
        inside = (at < DAYS) & (
            ~late | (F.dayofmonth(F.date_add(epoch, at.cast("int"))) > 12)
        )
        return F.when((i > 0) & inside, at).otherwise(moved)

    def written(day: Column) -> Column:
        date = F.date_add(epoch, day.cast("int"))
        return chosen(lambda form, _: F.date_format(date, form))

    day = F.datediff(
        chosen(lambda form, _: F.try_to_timestamp(value, F.lit(form))).cast("date"), epoch
    ).cast("long")
    fresh = _let(
        day,
        lambda d: F.when(
            d.between(0, DAYS - 1),
            _let(F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), d, step), written),
        ),
    )
    return F.coalesce(fresh, value)


def _email(key: str, value: Column) -> Column:
    local, host = (F.split_part(value, F.lit("@"), F.lit(i)) for i in (1, 2))
    fresh = permuted_characters(key, F.concat(F.lit("email"), F.lower(host)), local)
    return F.concat(fresh, F.lit("@"), host)


def _credential(key: str, value: Column) -> Column:
    """Piece by piece: the network's cost grows with the square of what it permutes."""
    pieces = F.regexp_extract_all(value, F.lit(f".{{1,{CREDENTIAL_PIECE}}}"), F.lit(0))

    def permuted(piece: Column, i: Column) -> Column:
        tweak = F.concat(F.lit("credential"), F.when(i > 0, i.cast("string")).otherwise(""))
        return permuted_characters(key, tweak, piece)

    return F.array_join(F.transform(pieces, permuted), "")


_REPLACED = {
    "email": _email,
    "credential": _credential,
    "iban": _iban,
    "date": _date,
    "ipv4": _ipv4,
    "card": _card,
    "ssn": _ssn,
    "phone": _phone,
}
#: Tells the kind of other findings than credentials, first match first.
_LOOKS = {
    "email": "@",
    "ipv4": r"^(?:[0-9]{1,3}[.]){3}[0-9]{1,3}$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "date": r"^(?:[0-9]{4}[\-/.][0-9]{2}[\-/.][0-9]{2}|[0-9]{2}[\-/.][0-9]{2}[\-/.][0-9]{4})$",
    "phone": r"^(?:[+(]|[0-9]{3}[.\-][0-9]{3}[.\-])",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}[ \-][0-9 \-]+)$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]{8,}$",
}


def pseudonym(value: Column, named: Column, key: str = KEY) -> Column:
    """The pseudonym of one finding; the finding itself where it does not validate.

    ``named`` holds for what is named as a credential.
    """
    out = F.when(named, _credential(key, value))
    for kind, look in _LOOKS.items():
        out = out.when(value.rlike(look), _REPLACED[kind](key, value))
    return out.otherwise(value)


def with_pseudonyms(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with the text rewritten, and ``n_pseudonyms``, the replaced findings."""
    text = F.col(text_col)

    def both(piece: Column, place: Column) -> Column:
        """A gap as it is; a finding without its flag, and its pseudonym."""
        old = F.when(place % 2 == 1, F.substring_index(piece, FLAG, -1)).otherwise(piece)
        named = ~piece.startswith(FLAG)
        new = F.when(place % 2 == 1, pseudonym(old, named, key)).otherwise(piece)
        return F.struct(old.alias("old"), new.alias("new"))

    # Gap, flagged finding, gap, ... in one pass over the text; in two where it holds
    # the mark.
    found = F.zip_with(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(1)),
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
        lambda group, finding: F.concat(group, F.lit(FLAG), finding),
    )
    in_two = F.flatten(
        F.zip_with(
            F.split(text, ANY, -1),
            F.concat(found, F.array(F.lit(""))),
            lambda gap, finding: F.array(gap, finding),
        )
    )
    in_one = F.split(F.regexp_replace(text, ANY, f"{MARK}$1{FLAG}$0{MARK}"), MARK, -1)
    pieces = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.when(F.contains(text, F.lit(MARK)), in_two).otherwise(in_one).alias("pieces"),
    )
    fresh = pieces.select("row", F.transform("pieces", both).alias("fresh"))
    joined = F.array_join(F.col("fresh.new"), "")
    changed = F.size(F.filter("fresh", lambda v: v["new"] != v["old"]))
    count = F.greatest(F.coalesce(changed, F.lit(0)), F.lit(0)).cast("long")
    return fresh.select(
        *(
            joined.alias(c) if c == text_col else F.col("row").getField(c).alias(c)
            for c in docs.columns
            if c != "n_pseudonyms"
        ),
        count.alias("n_pseudonyms"),
    )
