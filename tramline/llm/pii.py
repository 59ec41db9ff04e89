"""PII pseudonyms by format-preserving Feistel networks, with Catalyst expressions only.

Candidates are found by pattern and validated: card numbers by Luhn, IBANs by
mod 97, social security numbers by their numbering rules, IPv4 addresses by range,
dates by calendar. Every telephone number of ten digits counts; those that keep to the
North American rules and the others are two formats. A valid value is numbered within its
format, the number is permuted by a keyed Feistel network whose halves span
exactly the format's values, and the result is written in the same format with
its check digits made anew. So pseudonyms are valid values of their kind, equal
values get equal pseudonyms in every document however they are written, and the
key's owner can invert them. The local part of an e-mail address is permuted
likewise, letter by letter and digit by digit.

One value in several forms: a day as ISO, dotted or slashed date; a North American number with
any marks, bare or behind +1; a card or IBAN in groups or in one, an IBAN in either case; an
IPv6 address in full or shortened. The value is permuted, and written in the form found,
with two exceptions. An IPv6 address is always written in full. A day written 31/12/1999
whose pseudonym could be read month first gets dots in place of the slashes. A bare run of ten
digits is a telephone number only by the North American rules. E-mail addresses that differ in
case, and numbers of other countries in other groupings of the same digits, keep their own
letters and groups; the digits agree.

The key is the caller's. Rounds are HMACs with SHA-256; the key reaches the executors as a
column of a one-row table, so plans, their printouts and the event log don't show it.

A null text stays null; texts without valid values stay as they are.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import keep_columns

ROUNDS = 8
# The column that has the key's two HMAC blocks while pseudonyms are made.
KEY_COL = "__pseudonym_key__"
MIN_KEY_BYTES = 16

#: Patterns by kind, in the order in which they are tried at a place. Repeated groups are
#: bounded (a host name has at most 127 labels of 63 characters), so no text exhausts the stack.
PATTERNS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,125}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)|"
            r"[a-z]{2}[0-9]{2}(?:[a-z0-9]{11,30}|(?:\x20[a-z0-9]{4}){2,7}(?:\x20[a-z0-9]{1,3})?))(?![A-Za-z0-9])",
    "ipv6": r"(?<![A-Za-z0-9:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[23][0-9A-Fa-f]{3}|[Ff][CDEcde][0-9A-Fa-f]{2})"
            r"(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![A-Za-z0-9:]|\.[0-9])",
    "ipv4": r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![A-Za-z0-9]|\.[0-9])",
    "iso_date": r"(?<![A-Za-z0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![A-Za-z0-9]|-[0-9])",
    "day_date": r"(?<![A-Za-z0-9./])[0-9]{2}(?<dot>[./])[0-9]{2}\k<dot>[0-9]{4}(?![A-Za-z0-9]|[./][0-9])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9]|-[0-9])",
    "card": r"(?<![A-Za-z0-9.-])(?:[0-9]{13,19}|[0-9]{4}(?<four>[\x20-])[0-9]{4}\k<four>[0-9]{4}\k<four>[0-9]{1,7}|"
            r"[0-9]{4}(?<six>[\x20-])[0-9]{6}\k<six>[0-9]{5})"
            r"(?![A-Za-z0-9]|[.-][0-9])",
    "phone": r"(?<![A-Za-z0-9.+-])(?:(?:\+?1[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}|"
             r"(?:\+?1)?[2-9][0-9]{2}[2-9][0-9]{6})(?![A-Za-z0-9]|[.-][0-9])",
    "intl_phone": r"(?<![A-Za-z0-9+])\+[1-9][0-9]{0,2}(?:[\x20.-]?\([0-9]{1,4}\))?(?:[\x20.-]?[0-9]{2,4}){2,4}(?![A-Za-z0-9])",
}
ANY = "|".join(PATTERNS.values())
# No candidate is without one of these.
GATE = "[0-9@]|::"

#: Fixed: lengths of IBANs by country. Lower-case ones, which look much like other
#: identifiers, must have them.
IBAN_LENGTHS = """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27
GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24
ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24
TR26 UA29 VA22 VG24 XK20
""".split()


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def key_blocks(key: bytes) -> tuple[bytes, bytes]:
    """The key's blocks for the two hashes of an HMAC with SHA-256."""
    if not isinstance(key, bytes) or len(key) < MIN_KEY_BYTES:
        raise ValueError(f"a pseudonym key has {MIN_KEY_BYTES} bytes or more")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(x ^ 0x36 for x in block), bytes(x ^ 0x5C for x in block)


def with_key(df: DataFrame, key: bytes) -> DataFrame:
    """``df`` with the key's blocks in ``KEY_COL``, from a one-row table by a scalar subquery."""
    inner, outer = key_blocks(key)
    table = df.sparkSession.createDataFrame([((inner, outer),)], "k struct<inner: binary, outer: binary>")
    return df.withColumn(KEY_COL, table.select("k").scalar())


def _hmac(message: Column) -> Column:
    """HMAC-SHA-256 of a text, in hexadecimal."""
    key = F.col(KEY_COL)
    return F.sha2(F.concat(key["outer"], F.unhex(F.sha2(F.concat(key["inner"], message.cast("binary")), 256))), 256)


def plain_hmac(key: bytes, message: str) -> str:
    """What ``_hmac`` computes, for tests and for owners of a key."""
    return hmac.new(key, message.encode(), "sha256").hexdigest()


def _round(kind: Column | str, number: Column, other: Column) -> Column:
    """Keyed pseudo-random number under 2^60 for a round and the other half."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    mixed = _hmac(F.concat_ws("|", kind, number.cast("string"), other.cast("string")))
    return F.conv(F.substring(mixed, 1, 15), 16, 10).cast("long")


def permuted(left: Column, right: Column, a: Column, b: Column, kind: str, inverse: bool = False) -> Column:
    """struct<l, r>: a permutation of the pairs (left < a, right < b); a, b up to 10^15."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    sign = -1 if inverse else 1
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, lambda now, i: F.when(
        i % 2 == 1, F.struct(F.pmod(now["l"] + sign * (_round(kind, i, now["r"]) % a), a).alias("l"), now["r"].alias("r")),
    ).otherwise(
        F.struct(now["l"].alias("l"), F.pmod(now["r"] + sign * (_round(kind, i, now["l"]) % b), b).alias("r"))))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _padded(number: Column, n: Column) -> Column:
    return F.lpad(number.cast("string"), n, "0")


def permuted_digits(digits: Column, kind: str, inverse: bool = False) -> Column:
    """A permutation of the digit strings of the same length (1 to 30 digits)."""
    return _let(F.struct(digits.alias("d"), F.floor(F.length(digits) / 2).cast("int").alias("n"),
                         F.ceil(F.length(digits) / 2).cast("int").alias("m")),
                lambda x: _let(permuted(
                    F.coalesce(F.substring(x["d"], F.lit(1), x["n"]).try_cast("long"), F.lit(0)),
                    F.substring(x["d"], x["n"] + 1, x["m"]).cast("long"), _power(x["n"]), _power(x["m"]), kind, inverse),
                    lambda y: F.concat(F.when(x["n"] > 0, _padded(y["l"], x["n"])).otherwise(F.lit("")),
                                       _padded(y["r"], x["m"]))))


def _refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits``, one after the other."""
    chars = F.split(form, "", -1)
    return F.aggregate(
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda now, c: F.when(c.rlike("^[0-9]$"), F.struct(
            F.concat(now["out"], F.substring(digits, now["at"], F.lit(1))).alias("out"), (now["at"] + 1).alias("at"))).otherwise(
                F.struct(F.concat(now["out"], c).alias("out"), now["at"].alias("at"))),
        lambda done: done["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    places = F.reverse(F.split(digits, "", -1))
    doubled = F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda x, y: x + y)


def _card(form: Column, inverse: bool) -> Column:
    def made(digits: Column) -> Column:
        payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
        return _let(permuted_digits(payload, "card", inverse), lambda p: _refilled(
            form, F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string"))))

    return _let(_digits(form), lambda d: F.when((luhn_sum(d) % 10 == 0) & F.length(d).between(13, 19)
                                                & ~d.rlike("^0+$"), made(d)))


def mod97(text: Column) -> Column:
    """Remainder by 97 of an IBAN's characters, letters counting 10 to 35."""
    return F.aggregate(F.split(text, "", -1), F.lit(0), lambda now, c: F.when(
        c.rlike("[0-9]"), now * 10 + c.cast("int")).otherwise(now * 100 + F.ascii(c) - 55) % 97)


def _iban(form: Column, inverse: bool) -> Column:
    """Country and letters stay; the account's digits are permuted, the check digits follow."""
    def made(x: Column) -> Column:
        account = F.substring(x, F.lit(5), F.length(x))
        return _let(_refilled(account, permuted_digits(_digits(account), "iban", inverse)), lambda new: _let(
            F.lpad((98 - mod97(F.concat(new, F.substring(x, 1, 2), F.lit("00")))).cast("string"), 2, "0"),
            lambda check: _refilled(form, F.concat(check, _digits(new)))))

    plain = F.upper(F.replace(form, F.lit(" "), F.lit("")))
    known = F.array(*map(F.lit, IBAN_LENGTHS))
    return _let(plain, lambda x: F.when(
        (~form.rlike("[a-z]") | F.array_contains(known, F.concat(F.substring(x, 1, 2), F.length(x).cast("string"))))
        & (mod97(F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 4))) == 1)
        & F.length(_digits(F.substring(x, F.lit(5), F.length(x)))).between(2, 30), made(x)))


def _ipv4(form: Column, inverse: bool) -> Column:
    parts = F.transform(F.split(form, r"\.", -1), lambda p: p.cast("long"))

    def made(p: Column) -> Column:
        new = permuted(F.get(p, 0) * 256 + F.get(p, 1), F.get(p, 2) * 256 + F.get(p, 3), F.lit(65536), F.lit(65536), "ipv4", inverse)
        return _let(new, lambda n: F.concat_ws(".", *[x.cast("long").cast("string") for h in ("l", "r") for x in (
            F.floor(n[h] / 256), n[h] % 256)]))

    return _let(parts, lambda p: F.when(F.forall(p, lambda x: x < 256), made(p)))


#: Days of the Gregorian cycle of 400 years, and two factors of their number.
CYCLE, CYCLE_A, CYCLE_B = 146_097, 189, 773


def _date(day: Column, inverse: bool) -> Column:
    """Another day of the same 400-year cycle (cycles begin on 1 January of 1600, 2000, ...)."""
    since = F.datediff(day, F.lit("2000-01-01").cast("date"))
    return _let(F.struct(F.floor(since / CYCLE).alias("cycle"), F.pmod(since, F.lit(CYCLE)).alias("at")), lambda x: _let(
        permuted(F.floor(x["at"] / CYCLE_B), x["at"] % CYCLE_B, F.lit(CYCLE_A), F.lit(CYCLE_B), "date", inverse),
        lambda n: F.date_add(F.lit("2000-01-01").cast("date"),
                             (x["cycle"] * CYCLE + n["l"] * CYCLE_B + n["r"]).cast("int"))))


def _iso_date(form: Column, inverse: bool) -> Column:
    day = F.when(F.substring(form, 1, 4).cast("int").between(1601, 9599), form.try_cast("date"))
    return _let(day, lambda d: F.when(d.isNotNull(), F.date_format(_date(d, inverse), "yyyy-MM-dd")))


def _day_date(form: Column, inverse: bool) -> Column:
    """With dots day first; with slashes month first, unless the first number can only be a
    day: then day first too, with dots if the pseudonym's day could be a month."""
    a, b, year = F.substring(form, 1, 2), F.substring(form, 4, 2), F.substring(form, 7, 4)
    within = year.cast("int").between(1601, 9599)
    dots = F.substring(form, 3, 1) == "."
    day_first = dots | (a.cast("int") > 12)
    day = F.when(within, F.when(day_first, F.concat_ws("-", year, b, a)).otherwise(F.concat_ws("-", year, a, b)).try_cast("date"))
    return _let(day, lambda d: F.when(d.isNotNull(), _let(_date(d, inverse), lambda new: F.when(
        ~day_first, F.date_format(new, "MM/dd/yyyy")).when(
        dots | (F.dayofmonth(new) <= 12), F.date_format(new, "dd.MM.yyyy")).otherwise(F.date_format(new, "dd/MM/yyyy")))))


def _ipv6(form: Column, inverse: bool) -> Column:
    """The first 32 bits, the network's allocation, stay; the other 96 are permuted."""
    def expanded(text: Column) -> Column:
        sides = F.split(text, "::", -1)
        head = F.filter(F.split(F.get(sides, 0), ":", -1), lambda g: g != "")
        tail = F.filter(F.split(F.coalesce(F.get(sides, 1), F.lit("")), ":", -1), lambda g: g != "")
        gap = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(head) - F.size(tail), F.lit(0)))
        return F.transform(F.concat(head, gap, tail), lambda g: F.conv(g, 16, 10).cast("long"))

    def half(g: Column, i: int) -> Column:
        return (F.get(g, i) * 65536 + F.get(g, i + 1)) * 65536 + F.get(g, i + 2)

    def made(g: Column) -> Column:
        new = permuted(half(g, 2), half(g, 5), F.lit(1 << 48), F.lit(1 << 48), "ipv6", inverse)
        return _let(new, lambda n: F.concat_ws(":", *[F.lower(F.conv(x.cast("string"), 10, 16)) for x in (
            F.get(g, 0), F.get(g, 1), *[F.shiftright(n[h], k).bitwiseAND(65535) for h in ("l", "r") for k in (32, 16, 0)])]))

    return _let(expanded(form), lambda g: F.when(F.size(g) == 8, made(g)))


def _ssn(form: Column, inverse: bool) -> Column:
    """Areas 001 to 899 without 666, groups and serials from 1."""
    area, group, serial = (F.substring(form, *x).cast("int") for x in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
    return F.when(valid, _let(permuted(left, serial - 1, F.lit(898 * 99), F.lit(9999), "ssn", inverse), lambda n: _let(
        F.floor(n["l"] / 99) + 1, lambda area: F.concat_ws(
            "-", _padded(area + F.when(area >= 666, 1).otherwise(0), F.lit(3)), _padded(n["l"] % 99 + 1, F.lit(2)),
            _padded(n["r"] + 1, F.lit(4))))))


def _phone(form: Column, inverse: bool) -> Column:
    """Ten-digit numbers; the country code stays.

    Numbers whose area and exchange begin with 2 to 9 are permuted among themselves, and
    so are all others, so that a number keeps its kind and the inverse is exact.
    """
    def moved(x: Column, half: int, kind: str) -> Column:
        return _let(permuted(F.floor(x / half), x % half, F.lit(half), F.lit(half), kind, inverse),
                    lambda n: n["l"] * half + n["r"])

    def valid(ten: Column) -> Column:
        # 800 areas x 800 exchanges x 10,000 lines = 80,000 x 80,000
        area, exchange = F.floor(ten / 10_000_000) - 200, F.floor(ten / 10_000) % 1000 - 200
        return _let(moved((area * 800 + exchange) * 10_000 + ten % 10_000, 80_000, "phone"), lambda y: (
            (F.floor(y / 8_000_000) + 200) * 10_000_000 + (F.floor(y / 10_000) % 800 + 200) * 10_000 + y % 10_000))

    def other(ten: Column) -> Column:
        # 200 areas x 10,000,000 and 800 areas x 200 exchanges x 10,000 lines = 60,000 x 60,000
        low = 200 * 10_000_000
        number = F.when(ten < low, ten).otherwise(
            low + (F.floor(ten / 10_000_000) - 200) * 2_000_000 + ten % 10_000_000)
        return _let(moved(number, 60_000, "phone_other"), lambda y: F.when(y < low, y).otherwise(
            (F.floor((y - low) / 2_000_000) + 200) * 10_000_000 + (y - low) % 2_000_000))

    def made(d: Column) -> Column:
        ten = F.substring(d, F.length(d) - 9, F.lit(10))
        new = F.when(ten.rlike("^[2-9][0-9]{2}[2-9]"), valid(ten.cast("long"))).otherwise(other(ten.cast("long")))
        return _refilled(form, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), _padded(new, F.lit(10))))

    return _let(_digits(form), made)


def _intl_phone(form: Column, inverse: bool) -> Column:
    """Other international numbers of 8 to 15 digits: the first two digits stay. Those behind +1
    with ten more digits are the same numbers as without it."""
    return _let(_digits(form), lambda d: F.when(d.rlike("^1[0-9]{10}$"), _phone(form, inverse)).when(
        F.length(d).between(8, 15), _refilled(form, F.concat(
            F.substring(d, 1, 2), permuted_digits(F.substring(d, F.lit(3), F.length(d)), "intl_phone", inverse)))))


_SETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def _email(form: Column, inverse: bool) -> Column:
    """Letters and digits of the local part move within their sets; marks and domain stay.

    A Feistel network over the local part's two halves: each round shifts the
    characters of one half by numbers drawn from the other.
    """
    def shifted(chars: Column, other: Column, i: Column) -> Column:
        seed = F.concat_ws("|", F.lit("email"), i.cast("string"), F.array_join(other, ""))

        def shift(c: Column, k: Column) -> Column:
            draw = F.conv(F.substring(_hmac(F.concat_ws("|", seed, k.cast("string"))), 1, 8), 16, 10).cast("long")
            out = c
            for some in _SETS:
                at = F.instr(F.lit(some), c) - 1
                moved = F.pmod(at + (-1 if inverse else 1) * (draw % len(some)), F.lit(len(some))).cast("int")
                out = F.when(at >= 0, F.substring(F.lit(some), moved + 1, F.lit(1))).otherwise(out)
            return out

        return F.transform(chars, shift)

    def mixed(chars: Column) -> Column:
        half = F.floor(F.size(chars) / 2).cast("int")
        start = F.struct(F.slice(chars, F.lit(1), half).alias("l"), F.slice(chars, half + 1, F.size(chars)).alias("r"))
        rounds = F.sequence(F.lit(4), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(4))
        return F.aggregate(rounds, start, lambda now, i: F.when(
            i % 2 == 1, F.struct(shifted(now["l"], now["r"], i).alias("l"), now["r"].alias("r"))).otherwise(
                F.struct(now["l"].alias("l"), shifted(now["r"], now["l"], i).alias("r"))),
            lambda done: F.array_join(F.concat(done["l"], done["r"]), ""))

    at = F.instr(form, "@")
    return F.concat(_let(F.split(F.substring(form, F.lit(1), at - 1), "", -1), mixed), F.substring(form, at, F.length(form)))


MAKERS = {"email": _email, "iban": _iban, "ipv6": _ipv6, "ipv4": _ipv4, "iso_date": _iso_date, "day_date": _day_date, "ssn": _ssn,
          "card": _card, "phone": _phone, "intl_phone": _intl_phone}


def _kind(hit: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        out = F.when(hit.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def _pseudonym(hit: Column, inverse: bool) -> Column:
    """struct<kind, old, new>: new is null where the value isn't valid."""
    def made(kind: Column) -> Column:
        new = F.lit(None).cast("string")
        for name, maker in MAKERS.items():
            new = F.when(kind == name, maker(hit, inverse)).otherwise(new)
        return F.struct(kind.alias("kind"), hit.alias("old"), new.alias("new"))

    return _let(_kind(hit), made)


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", inverse: bool = False) -> DataFrame:
    """``docs`` with the text's valid values replaced, n_pii and pii_kinds.

    ``key`` is secret, of 16 bytes or more. ``inverse`` takes pseudonyms back to the values. pii_kinds is a map from kind to
    count. Columns with the added names are replaced; others pass through.
    """
    kept = keep_columns(docs, ["n_pii", "pii_kinds"])
    docs = with_key(docs, key)
    text = F.col(text_col)
    # Most texts have no candidate; those pass by on one search.
    some = text.rlike(GATE) & text.rlike(ANY)
    hits = F.when(some, F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
                                               lambda h: _pseudonym(h, inverse)))
    gaps = F.when(some, F.split(text, ANY, -1))
    found = docs.select(*kept, hits.alias("__hits__"), gaps.alias("__gaps__"))
    news = F.transform("__hits__", lambda h: F.coalesce(h["new"], h["old"]))
    joined = F.array_join(F.transform(F.arrays_zip(F.col("__gaps__").alias("g"), news.alias("n")),
                                      lambda x: F.concat(x["g"], F.coalesce(x["n"], F.lit("")))), "")
    valid = F.filter(F.coalesce(F.col("__hits__"), F.array().cast("array<struct<kind:string,old:string,new:string>>")),
                     lambda h: h["new"].isNotNull())
    kinds = F.map_from_entries(F.transform(
        F.array_distinct(F.transform("__valid__", lambda h: h["kind"])),
        lambda k: F.struct(k, F.size(F.filter("__valid__", lambda h: h["kind"] == k)))))
    made = found.withColumn("__valid__", valid)
    out = [F.when(F.size("__valid__") > 0, joined).otherwise(F.col(text_col)).alias(c) if c == text_col else F.col(c)
           for c in kept]
    return made.select(*out, F.size("__valid__").cast("long").alias("n_pii"), kinds.alias("pii_kinds"))
