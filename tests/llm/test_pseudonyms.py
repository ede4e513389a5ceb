import datetime as dt
import hashlib
import re

import regex
from pyspark.sql import functions as F

from demandlab.llm.pseudonyms import DAYS, KINDS, PATTERNS, _walked, check_sum, permuted, pseudonymized

KEY = "test key"


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def rewritten(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in pseudonymized(rows, KEY).collect()}


def test_values_keep_their_format_and_their_links(spark):
    texts = [
        "call +1 (736) 555-2678 now", "again +1 (736) 555-2678.", "card 4539 1488 0343 6467, x", "same 4539148803436467", "not a card 4539 1488 0343 6468", "ip 42.144.35.254.", "no ip 300.1.1.1",
        "born 2001-02-03 or 3.2.2001 or 03/02/2001", "no day 2001-02-30", "mail Ab.c42@mail8.example.com, Ab.c42@other.org", "", None, "plain text 12 345", "+1 (269) 555-3296 4539148803436467",
    ]
    rows = rewritten(spark, *texts)
    out = [rows[k].text for k in range(len(texts))]
    phone = re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}) now", out[0])[1]
    assert phone != "+1 (736) 555-2678" and out[1] == f"again {phone}."
    card = re.fullmatch(r"card (4\d{3} \d{4} \d{4} \d{4}), x", out[2])[1]
    assert luhn(card) and card != "4539 1488 0343 6467" and out[3] == "same " + card.replace(" ", "")
    ip = re.fullmatch(r"ip (\d+\.\d+\.\d+\.\d+)\.", out[5])[1]
    assert ip != "42.144.35.254" and all(int(x) < 256 for x in ip.split("."))
    days = re.fullmatch(r"born (\d{4}-\d\d-\d\d) or (\d+)\.(\d+)\.(\d{4}) or (\d\d)/(\d\d)/(\d{4})", out[7])
    day = dt.date.fromisoformat(days[1])
    assert day != dt.date(2001, 2, 3) and (int(days[2]), int(days[3]), int(days[4])) == (day.day, day.month, day.year) == (int(days[5]), int(days[6]), int(days[7]))
    names = re.fullmatch(r"mail (([A-Z][a-z]\.[a-z]\d\d)@mail8\.example\.com), (.*)@other\.org", out[9])
    assert names[2] == names[3] != "Ab.c42"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} " + out[3][5:], out[13])
    for k in (4, 6, 8, 10, 11, 12):
        assert out[k] == texts[k]
    counts = {k: [getattr(rows[k], f"n_{kind}") for kind in KINDS] for k in rows}
    assert counts[7] == [0, 0, 3, 0, 0] and counts[9] == [2, 0, 0, 0, 0] and counts[13] == [0, 0, 0, 1, 1] and counts[11] == [0] * 5 == counts[4]


def test_numbers_are_permuted(spark):
    rows = spark.range(1000).select(F.transform(F.split(F.lpad(F.col("id").cast("string"), 3, "0"), ""), lambda c: c.cast("int")).alias("d"))
    rows = rows.select(permuted(F.col("d"), 10, KEY, "x").alias("p"), permuted(F.col("d"), 10, "other", "x").alias("q"))
    found = [(tuple(r.p), tuple(r.q)) for r in rows.collect()]
    assert len({p for p, _ in found}) == 1000 == len({q for _, q in found})
    assert all(0 <= d < 10 for p, _ in found for d in p) and sum(p == q for p, q in found) < 20


def test_days_are_permuted(spark):
    row = spark.range(DAYS).select(_walked(F.col("id").cast("int"), KEY).alias("d")).agg(F.countDistinct("d"), F.min("d"), F.max("d")).first()
    assert tuple(row) == (DAYS, 0, DAYS - 1)


def test_check_sum(spark):
    rows = spark.createDataFrame([([int(c) for c in n],) for n in ("4539148803436467", "79927398713", "0")], "d array<int>")
    assert [r[0] % 10 for r in rows.select(check_sum(F.col("d"))).collect()] == [0, 0, 0]


def test_only_spark_functions_and_other_columns_stay(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, n_ip string, other int")
    result = pseudonymized(frame, KEY)
    assert "Python" not in result._jdf.queryExecution().toString()
    assert result.collect() == [] and set(result.columns) == {"doc_id", "text", "other", *(f"n_{k}" for k in KINDS)}


def test_cards_beside_other_numbers(spark):
    one, other = "4845168114407329", "4539148803436467"
    assert luhn(one) and luhn(other)
    texts = [
        one, f"{one} 123", f"12 {one}", "4845 1681 1440 7329 12/27", f"98765 {one}", f"{one} {other}", f"{one} 42.144.35.254", f"{one} 2001-02-03", f"{one} 03/02/2001", f"{one} 12ab@x.org",
        f"{one} 2001-02-03/4", "x " + "1 " * 20000 + "y", f"{'7' * 30} {one}", f"{one}  {other}", "4845-1681-1440-7329-" + other,
    ]
    rows = rewritten(spark, *texts)
    out, counts = [rows[k].text for k in range(len(texts))], [rows[k].n_card for k in range(len(texts))]
    new = out[0]
    assert new != one and luhn(new) and counts[0] == 1
    second = out[5].split()[1]
    # Longer cards may come first where the neighbour makes one; these neighbours do not.
    assert out[1] == f"{new} 123" and out[2] == f"12 {new}" and out[4] == f"98765 {new}" and out[5] == f"{new} {second}" and second != other and luhn(second)
    assert out[3].replace(" ", "") == f"{new}12/27" and out[3][4] == out[3][9] == out[3][14] == " "
    assert out[6].startswith(f"{new} ") and rows[6].n_ip == 1 and rows[7].n_date == 1 == rows[8].n_date and rows[9].n_email == 1
    assert all(out[k].startswith(f"{new} ") and counts[k] == 1 for k in (6, 7, 8, 9, 10))
    assert out[12] == f"{'7' * 30} {new}" and out[13] == f"{new}  {second}" and counts[13] == counts[5] == counts[14] == 2
    assert out[14].replace("-", "") == new + second


def test_a_host_of_very_many_labels_ends_no_executor(documents):
    texts = ["x@a" + ".b" * n + " end" for n in (500, 2_000, 100_000)]
    found = {r["doc_id"]: r["text"] for r in pseudonymized(documents(*enumerate(texts)), key="k").collect()}
    for k, text in enumerate(texts):
        assert len(found[k]) == len(text) and found[k].endswith(text[1:]) and found[k] != text


# The same in plain Python, value by value.


def plain_permuted(places, radixes, kind):
    half = len(places) // 2
    left, right, of_left, of_right = places[:half], places[half:], radixes[:half], radixes[half:]
    for k in range(1, 9):
        seed = f"{KEY}|{kind}|{k}|{','.join(map(str, right))}"
        added = [int(hashlib.sha256(f"{seed}|{i // 16}".encode()).hexdigest()[i % 16 * 4 :][:4], 16) for i in range(len(left))]
        left, right, of_left, of_right = right, [(d + a) % n for d, a, n in zip(left, added, of_left)], of_right, of_left
    return left + right


def plain_filled(text, values, fits):
    values = iter(values)
    return "".join(str(next(values)) if fits(c) else c for c in text)


def plain_card(number):
    digits = [int(c) for c in number if c in "0123456789"]
    body = digits[:1] + plain_permuted(digits[1:-1], [10] * (len(digits) - 2), "card")
    last = next(d for d in range(10) if luhn("".join(map(str, [*body, d]))))
    return plain_filled(number, [*body, last], lambda c: c in "0123456789")


def plain_cards(run):
    groups, out, at, n = [m.span() for m in re.finditer("[0-9]+", run)], "", 0, 0
    i = 0
    while i < len(groups):
        numbers = [(j, "".join(run[a:b] for a, b in groups[i : j + 1])) for j in range(i, min(i + 19, len(groups)))]
        ends = [j for j, number in numbers if 13 <= len(number) <= 19 and luhn(number)]
        if ends:
            first, last = groups[i][0], groups[ends[-1]][1]
            out, at, n, i = out + run[at:first] + plain_card(run[first:last]), last, n + 1, ends[-1] + 1
        else:
            i += 1
    return (out + run[at:], n) if n else (None, 1)


def plain_date(text):
    parts, sign = re.split("[./-]", text), re.search("[./-]", text)[0]
    orders = [(0, 1, 2)] if sign == "-" else [(2, 1, 0), (2, 0, 1)] if sign == "/" else [(2, 1, 0)]
    for year, month, day in orders:
        try:
            n = (dt.date(int(parts[year]), int(parts[month]), int(parts[day])) - dt.date(1900, 1, 1)).days
        except ValueError:
            continue
        if 0 <= n < DAYS:
            while True:
                a, b = plain_permuted([n // 270, n % 270], [271, 270], "date")
                n = a * 270 + b
                if n < DAYS:
                    break
            new = dt.date(1900, 1, 1) + dt.timedelta(days=n)
            values = {year: new.year, month: new.month, day: new.day}
            return sign.join(str(values[k]).zfill(len(parts[k])) if len(parts[k]) > 1 else str(values[k]) for k in range(3))
    return None


def plain_value(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "card":
        return plain_cards(value)
    if kind == "date":
        return plain_date(value), 1
    if kind == "ip":
        numbers = [int(x) for x in value.split(".")]
        return ".".join(map(str, plain_permuted(numbers, [256] * 4, "ip"))) if max(numbers) < 256 else None, 1
    if kind == "phone":
        new = digits[:1] + plain_permuted(digits[1:], [10] * (len(digits) - 1), "phone")
        return plain_filled(value, new, lambda c: c in "0123456789") if 8 <= len(digits) <= 15 else None, 1
    name, host = value.split("@")
    fits = lambda c: regex.match(r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}\p{Mn}\p{Nd}]", c) is not None
    chars = [c for c in name if fits(c)]
    kinds = [(10, ord("0")) if c in "0123456789" else (26, ord("A" if c.isupper() else "a")) if c.isascii() else (64, ord(c) // 64 * 64) for c in chars]
    new = plain_permuted([ord(c) - start for c, (_, start) in zip(chars, kinds)], [n for n, _ in kinds], "email")
    return plain_filled(name, [chr(start + v) for v, (_, start) in zip(new, kinds)], fits) + "@" + host, 1


def plain(text):
    counts = dict.fromkeys(KINDS, 0)
    if text is None:
        return None, counts

    def put(m):
        kind = next(k for k in KINDS if k == "card" or regex.fullmatch(PATTERNS[k], m[0]))
        new, n = plain_value(kind, m[0])
        counts[kind] += n if new is not None else 0
        return m[0] if new is None else new

    return regex.sub("|".join(f"(?:{PATTERNS[k]})" for k in KINDS), put, text), counts


def test_equals_plain_python_on_whole_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    total = dict.fromkeys(KINDS, 0)
    for r in pseudonymized(documents, KEY).collect():
        text, counts = plain(texts[r.doc_id])
        assert r.text == text and [r[f"n_{k}"] for k in KINDS] == list(counts.values())
        total = {k: total[k] + counts[k] for k in KINDS}
    assert sum(n > 0 for n in total.values()) >= 3


def test_values_written_in_other_ways(spark):
    spaced = "4845 1681 1440 7329"
    texts = [
        "born 12/25/1980.", "born 25/12/1980.", "no day 13/32/1980", "Jürgen.müller@münchen.de", "mail иван.петров@пример.рф now", "写信给test@example.com请", "e\u0301va@x.org",
        spaced.replace(" ", "\t"), spaced.replace(" ", "."), spaced.replace(" ", "  "), "1234\t" + spaced.replace(" ", "\t"), "9999\t" * 5, "1999.2000.2001.2002", "x 4539.1488.0343.6467.4845.1681.1440.7329",
        spaced, "12/25/1980 12.25.1980", "ip 10.0.0.1 4845.1681.1440.7329 10.0.0.2",
    ]
    rows = rewritten(spark, *texts)
    out = [rows[k].text for k in range(len(texts))]
    assert [(t, c) for t, c in (plain(t) for t in texts)] == [(rows[k].text, {kind: rows[k][f"n_{kind}"] for kind in KINDS}) for k in range(len(texts))]
    us, day = re.fullmatch(r"born (\d\d)/(\d\d)/(\d{4})\.", out[0]), re.fullmatch(r"born (\d\d)/(\d\d)/(\d{4})\.", out[1])
    assert (us[1], us[2], us[3]) == (day[2], day[1], day[3]) and out[0] != texts[0] and out[2] == texts[2]
    assert out[3].endswith("@münchen.de") and "ürgen" not in out[3] and "mü" not in out[3].split("@")[0]
    assert out[4].startswith("mail ") and out[4].endswith("@пример.рф now") and "иван" not in out[4]
    assert out[5].startswith("写信给") and out[5].endswith("@example.com请") and "test" not in out[5]
    new = out[14].split()
    assert all(out[k] == sign.join(new) for k, sign in ((7, "\t"), (8, "."), (9, "  "))) and out[11] == texts[11] and out[12] == texts[12]
    assert rows[13].n_card == 2 and out[13].endswith(".".join(new)) and out[15].endswith("12.25.1980")
    assert rows[16].n_ip == 2 and ".".join(new) in out[16]


def test_clashing_columns_stay(spark):
    rows = spark.createDataFrame([(1, "ip 10.0.0.1", "a", "b", "c", 7)], "doc_id long, text string, _found string, _NEW string, `a.b` string, n_ip int")
    r = pseudonymized(rows, KEY).first()
    assert (r["_found"], r["_NEW"], r["a.b"], r["n_ip"]) == ("a", "b", "c", 1) and r.text != "ip 10.0.0.1"
