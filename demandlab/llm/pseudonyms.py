"""Format-preserving pseudonyms for personal numbers, dates and addresses in texts.

What is found in a text is validated and replaced by a keyed permutation within
its own format, so equal values become equal pseudonyms in every document:

  email   the letters and digits of the name before the @, each within its kind; a letter
          beyond a-z within its own 64 code points (names and hosts of Latin, Greek and
          Cyrillic letters; others would take in the words of scripts without spaces)
  ip      four numbers up to 255, as one value of four places
  date    a day from 1900 to 2099, written the same way (2001-02-03, 3.2.2001, 03/02/2001);
          between slashes the month comes first where the day cannot (12/25/1980)
  phone   +, country code and 7 to 14 more digits: all digits after the first
  card    13 to 19 digits with a right check digit: all but the first digit; the
          check digit is then right again; in a run of numbers between single spaces
          or hyphens, any neighbouring ones that make a card, the leftmost and
          then the longest first; also in groups between tabs, points or two spaces that
          start with four digits as cards do

The permutation is a Feistel network over the places of a value: each round adds
to one part, place by place, what SHA-256 makes of the key, the round and the
other part. Days use two places and walk on until the result is a day. All is
made of Spark functions.

Cases: a null text stays null; what fails validation stays as it is; repeated
rows and rows without an id are treated like others; other columns pass through,
whatever their names, but for n_email and so on, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "ip", "date", "phone", "card")
#: Letters, their marks and numbers of names and hosts.
_LETTER = r"\p{IsLatin}\p{IsGreek}\p{IsCyrillic}\p{Mn}\p{Nd}"
PATTERNS = {
    # The host is possessive: nothing follows it, and a long one needs no stack.
    "email": rf"[{_LETTER}._%+-]{{1,64}}@[{_LETTER}-]{{1,63}}(?:\.[{_LETTER}-]{{1,63}})++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])",
}
#: A run of numbers; it ends before what another pattern takes. Possessive, so that long runs need no stack.
PATTERNS["card"] = rf"(?<![0-9])(?=(?:[0-9][ -]?){{13}})[0-9]++(?:[ -](?!{'|'.join(PATTERNS[k] for k in ('email', 'ip', 'date'))})[0-9]++)*+"
#: Groups between wider signs, the same ones throughout; only after four digits as cards have them, as tables of numbers look alike.
_WIDE = "|".join(rf"(?<![0-9])[3-6][0-9]{{3}}{sign}[0-9]{{4,6}}(?:{sign}[0-9]{{1,7}}(?![0-9]))++" for sign in (r"\t", r"\.", " {2}"))
PATTERNS["card"] = f"{_WIDE}|{PATTERNS['card']}"
#: Kinds by what was found: a run has no signs around it that could tell it from a date.
_FOUND = {k: f"^(?:{p})$" for k, p in PATTERNS.items()} | {"card": r"^[0-9][0-9 \t.-]*$"}
#: How many neighbouring code points a letter beyond a-z is permuted among.
BLOCK = 64
FIRST_DAY, DAYS = "1900-01-01", 73049
#: Two places whose product is just above the number of days.
_A, _B = 271, 270


def _stream(key: str, kind: str, round_: Column, half: Column, place: Column) -> Column:
    """A number from 0 to 65535 for each place, from the key, the round and the other half."""
    seed = F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), F.array_join(F.transform(half, lambda d: d.cast("string")), ","))
    digest = F.sha2(F.concat(seed, F.lit("|"), F.floor(place / 16).cast("string")), 256)
    return F.conv(F.substring(digest, F.pmod(place, F.lit(16)).cast("int") * 4 + 1, F.lit(4)), 16, 10).cast("int")


def permuted(places: Column, radix: Column, key: str, kind: str) -> Column:
    """A permutation of the arrays of numbers below `radix` of one length; radix: a number, or an array with one for each place."""
    half = F.floor(F.size(places) / 2).cast("int")
    radixes = radix if isinstance(radix, Column) else F.transform(places, lambda _: F.lit(radix))
    start = F.struct(
        F.slice(places, F.lit(1), half).alias("l"), F.slice(places, half + 1, F.size(places) - half).alias("r"),
        F.slice(radixes, F.lit(1), half).alias("lr"), F.slice(radixes, half + 1, F.size(places) - half).alias("rr"),
    )

    def one(state: Column, round_: Column) -> Column:
        moved = F.transform(state["l"], lambda d, i: F.pmod(d + _stream(key, kind, round_, state["r"], i), F.get(state["lr"], i)).cast("int"))
        return F.struct(state["r"].alias("l"), moved.alias("r"), state["rr"].alias("lr"), state["lr"].alias("rr"))

    # An even number of rounds brings both halves back to their sides.
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one, lambda s: F.concat(s["l"], s["r"]))


def _digits(text: Column) -> Column:
    return F.transform(F.filter(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda c: c != ""), lambda c: c.cast("int"))


def _refilled(text: Column, pattern: str, values: Column) -> Column:
    """The text with its characters of the pattern replaced by the values in turn."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    put = lambda s, c: F.when(c.rlike(pattern), F.struct(F.concat(s["out"], F.get(values, s["n"])).alias("out"), (s["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["n"].alias("n")))
    return F.aggregate(chars, start, put, lambda s: s["out"])


def _strings(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("string"))


def check_sum(digits: Column) -> Column:
    """The sum that the check digit makes a multiple of ten: every second digit from the right counts twice."""
    doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def card(text: Column, key: str) -> Column:
    digits = _digits(text)
    n = F.size(digits)
    body = F.concat(F.slice(digits, 1, 1), permuted(F.slice(digits, F.lit(2), n - 2), 10, key, "card"))
    check = F.pmod(10 - F.pmod(check_sum(F.concat(body, F.array(F.lit(0)))), F.lit(10)), F.lit(10))
    new = _refilled(text, "[0-9]", _strings(F.concat(body, F.array(check))))
    return F.when(F.pmod(check_sum(digits), F.lit(10)) == 0, new)


def _let(value: Column, made) -> Column:
    """What `made` makes of the value, which is worked out once."""
    return F.transform(F.array(value), made)[0]


def _cards(groups: Column) -> Column:
    """(first, last) of the neighbouring groups of digits that make a card, from the left, longest first."""
    n = F.size(groups)

    def valid(number: Column) -> Column:
        return F.char_length(number).between(13, 19) & (F.pmod(check_sum(_digits(number)), F.lit(10)) == 0)

    def last(i: Column) -> Column:
        ends = F.filter(F.sequence(i, F.least(i + 18, n - 1)), lambda e: _let(F.array_join(F.slice(groups, i + 1, e - i + 1), ""), valid))
        return F.coalesce(F.array_max(ends), F.lit(-1))

    def one(state: Column, span: Column) -> Column:
        taken = F.struct(F.concat(state["cards"], F.array(span)).alias("cards"), (span["last"] + 1).alias("next"))
        return F.when(span["first"] >= state["next"], taken).otherwise(state)

    starts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("first"), last(i).alias("last")))
    begin = F.struct(F.array().cast("array<struct<first:int,last:int>>").alias("cards"), F.lit(0).alias("next"))
    return F.aggregate(F.filter(starts, lambda s: s["last"] >= 0), begin, one, lambda s: s["cards"])


def cards(run: Column, key: str) -> Column:
    """(new, n): the run with its cards replaced, null if it has none, and their number."""
    after = F.split(run, "[0-9]+", -1)

    def rewritten(parts: Column) -> Column:
        groups, ends, found = parts["groups"], parts["ends"], parts["cards"]

        def text(first: Column, end: Column) -> Column:
            """The groups from first up to end, each with the sign after it."""
            return F.array_join(F.slice(ends, first + 1, end - first), "")

        def one(span: Column, k: Column) -> Column:
            before = F.when(k == 0, 0).otherwise(F.get(found, k - 1)["last"] + 1)
            new = _let(F.concat(text(span["first"], span["last"]), F.get(groups, span["last"])), lambda number: card(number, key))
            sign = F.substring(F.get(ends, span["last"]), F.char_length(F.get(groups, span["last"])) + 1, F.lit(2))
            return F.concat(text(before, span["first"]), new, sign)

        rest = text(F.get(found, F.size(found) - 1)["last"] + 1, F.size(groups))
        new = F.concat(F.array_join(F.transform(found, one), ""), rest)
        return F.struct(F.when(F.size(found) > 0, new).alias("new"), F.size(found).alias("n"))

    def split(groups: Column) -> Column:
        ends = F.zip_with(groups, F.slice(after, F.lit(2), F.size(groups)), lambda g, a: F.concat(g, a))
        return _let(F.struct(groups.alias("groups"), ends.alias("ends"), _cards(groups).alias("cards")), rewritten)

    return _let(F.regexp_extract_all(run, F.lit("[0-9]+"), F.lit(0)), split)


def phone(text: Column, key: str) -> Column:
    digits = _digits(text)
    n = F.size(digits)
    new = F.concat(F.slice(digits, 1, 1), permuted(F.slice(digits, F.lit(2), n - 1), 10, key, "phone"))
    return F.when(n.between(8, 15), _refilled(text, "[0-9]", _strings(new)))


def ip(text: Column, key: str) -> Column:
    numbers = F.transform(F.split(text, r"\."), lambda x: x.cast("int"))
    return F.when(F.forall(numbers, lambda x: x <= 255), F.array_join(_strings(permuted(numbers, 256, key, "ip")), "."))


def email(text: Column, key: str) -> Column:
    """Letters keep their case and place, digits their place; the host stays."""
    name = F.substring_index(text, "@", 1)
    chars = F.filter(F.split(name, ""), lambda c: c.rlike(f"[{_LETTER}]"))
    digit, plain = (lambda c: c.rlike("[0-9]")), (lambda c: c.rlike("[A-Za-z]"))
    places = F.transform(chars, lambda c: F.when(digit(c), F.ascii(c) - 48).when(plain(c), F.ascii(F.lower(c)) - 97).otherwise(F.ascii(c) % BLOCK))
    radix = F.transform(chars, lambda c: F.when(digit(c), 10).when(plain(c), 26).otherwise(BLOCK))
    letter = lambda v, upper: F.call_function("char", F.when(upper, v + 65).otherwise(v + 97))
    code_point = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")

    def written(v: Column, c: Column) -> Column:
        beyond = code_point(F.ascii(c) - F.ascii(c) % BLOCK + v)
        return F.when(digit(c), v.cast("string")).when(plain(c), letter(v, c.rlike("[A-Z]"))).otherwise(beyond)

    new = F.zip_with(permuted(places, radix, key, "email"), chars, written)
    return F.concat(_refilled(name, f"[{_LETTER}]", new), F.substring(text, F.char_length(name) + 1, F.char_length(text)))


def _walked(day: Column, key: str) -> Column:
    """The day's place in a permutation of the days: of the two places' values, those beyond the days are walked over."""
    step = lambda d: F.transform(F.array(permuted(F.array(F.floor(d / _B).cast("int"), F.pmod(d, F.lit(_B)).cast("int")), F.array(F.lit(_A), F.lit(_B)), key, "date")), lambda p: p[0] * _B + p[1])[0]
    first = step(day)
    return F.aggregate(F.sequence(F.lit(1), F.lit(_A * _B - DAYS)), first, lambda d, _: F.when(d < DAYS, d).otherwise(step(d)))


def date(text: Column, key: str) -> Column:
    iso, sign = text.contains("-"), F.when(text.contains("/"), "/").otherwise(".")
    parts = F.split(text, "[./-]")
    two = lambda part, value: F.when(F.char_length(part) == 2, F.lpad(value.cast("string"), 2, "0")).otherwise(value.cast("string"))

    def number(year: Column, month: Column, day: Column) -> Column:
        written = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.datediff(F.try_to_date(written, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))

    def renewed(day: Column) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), _walked(day, key))

    def iso_text(day: Column) -> Column:
        return F.date_format(renewed(day), "yyyy-MM-dd")

    def day_first(day: Column) -> Column:
        return _let(renewed(day), lambda d: F.concat(two(parts[0], F.dayofmonth(d)), sign, two(parts[1], F.month(d)), sign, F.year(d).cast("string")))

    def month_first(day: Column) -> Column:
        return _let(renewed(day), lambda d: F.concat(two(parts[0], F.month(d)), sign, two(parts[1], F.dayofmonth(d)), sign, F.year(d).cast("string")))

    def put(days: Column) -> Column:
        known = lambda day: day.between(0, DAYS - 1)
        return (
            F.when(known(days["iso"]), iso_text(days["iso"]))
            .when(known(days["day_first"]), day_first(days["day_first"]))
            .when(known(days["month_first"]), month_first(days["month_first"]))
        )

    days = F.struct(
        F.when(iso, number(parts[0], parts[1], parts[2])).alias("iso"),
        F.when(~iso, number(parts[2], parts[1], parts[0])).alias("day_first"),
        F.when(text.contains("/"), number(parts[2], parts[0], parts[1])).alias("month_first"),
    )
    return _let(days, put)


def pseudonymized(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns with the text rewritten, and n_email, n_ip, n_date, n_phone, n_card: values replaced."""
    makers = {"email": email, "ip": ip, "date": date, "phone": phone}
    combined = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)

    def replaced(found: Column) -> Column:
        """(kind, new, n): n values of the kind; new is null if no validation holds."""
        out = None
        for kind in KINDS:
            fits = found.rlike(_FOUND[kind])
            if kind == "card":
                value = _let(cards(found, key), lambda c: F.struct(F.lit("card").alias("kind"), c["new"].alias("new"), c["n"].alias("n")))
            else:
                value = F.struct(F.lit(kind).alias("kind"), makers[kind](found, key).alias("new"), F.lit(1).alias("n"))
            out = F.when(fits, value) if out is None else out.when(fits, value)
        return out

    columns = [c for c in documents.columns if c not in {f"n_{k}" for k in KINDS}]
    taken = {c.lower() for c in columns}
    old, new = (next(n for n in (f"_{name}" + "_" * k for k in range(len(taken) + 1)) if n not in taken) for name in ("found", "new"))
    text_of = F.col(f"`{text}`")
    found = documents.select(*[f"`{c}`" for c in columns]).withColumn(old, F.when(text_of.rlike(combined), F.regexp_extract_all(text_of, F.lit(combined), F.lit(0))))
    # Equal values are permuted alike, so a text works on its own few; the rest of the text is what stands between.
    found = found.withColumn(new, F.transform(old, replaced))
    between = F.split(text_of, combined, -1)
    values = F.zip_with(old, new, lambda was, now: F.coalesce(now["new"], was))
    pieces = F.zip_with(values, F.slice(between, F.lit(2), F.size(old)), lambda value, after: F.concat(value, after))
    rewritten = F.when(F.col(old).isNull(), text_of).otherwise(F.concat(between[0], F.array_join(pieces, "")))

    def count(kind: str) -> Column:
        kept = F.filter(new, lambda x: (x["kind"] == kind) & x["new"].isNotNull())
        return F.when(F.col(new).isNull(), 0).otherwise(F.aggregate(kept, F.lit(0), lambda a, x: a + x["n"])).cast("long")

    counts = {f"n_{kind}": count(kind) for kind in KINDS}
    return found.withColumns({text: rewritten, **counts}).drop(old, new)
