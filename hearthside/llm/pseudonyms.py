"""Personal data replaced by keyed pseudonyms of the same format, in DataFrame functions alone.

Spans are found by one pattern and validated (Luhn sum, IBAN check, calendar, octets). The characters that carry the
value become cells (value, radix) and pass a Feistel network whose round function is SHA-256 of key, kind, round and
the other half, added modulo each cell's radix. The network is a permutation of the format, so equal values get equal
pseudonyms in all documents and different values never meet. Check digits are computed anew. With the key,
``restore=True`` gives the values back.

A key must be kept secret; the value in the query is a placeholder for tests.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# fixed values: the span patterns, in order of precedence
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z0-9-]{2,}+",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=(?i:password) ?[=:] ?)[A-Za-z0-9]{6,}+|(?<=(?i:token = \"))[A-Za-z0-9]{16,}+(?=\")",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}[./][0-9]{2}[./](?:19|20)[0-9]{2})(?![0-9/-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "abroad": r"(?<![0-9A-Za-z+])\+(?!1[ .-])[1-9][0-9](?:[ .-]?[0-9]{2,5}){2,5}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|(?!(?:[0-9]{1,3}[ -]){1,3}(?:[0-9]{13,}|[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])))[0-9](?:[ -]?[0-9]){12,18})(?![0-9A-Za-z])",
}
SPAN = "|".join(f"(?:{p})" for p in PATTERNS.values())
# days from 1900-01-01 that a date is permuted in: 250 * 292 = 73,000, to 2099-11-12
FIRST_DAY, DAY_CELLS = "1900-01-01", (250, 292)


def _cell(value: Column, radix) -> Column:
    return F.struct(value.cast("bigint").alias("v"), (radix if isinstance(radix, Column) else F.lit(radix)).cast("bigint").alias("m"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def feistel(cells: Column, key: str, kind: str, restore: bool = False) -> Column:
    """Permute an array of (v, m) cells. A single cell, which has no halves, takes its place in a keyed order of its values."""
    return _let(cells, lambda c: F.when(F.size(c) == 1, _shuffled(c, key, kind, restore)).otherwise(_feistel(c, key, kind, restore)))


def _shuffled(cells: Column, key: str, kind: str, restore: bool) -> Column:
    v, m = cells[0]["v"], cells[0]["m"]
    mark = lambda x: F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit("single"), m.cast("string"), x.cast("string")), 256)
    order = F.transform(F.array_sort(F.transform(F.sequence(F.lit(0).cast("bigint"), m - 1), lambda x: F.struct(mark(x).alias("h"), x.alias("x")))), lambda p: p["x"])
    new = F.array_position(order, v) - 1 if restore else F.element_at(order, (v + 1).cast("int"))
    return F.array(_cell(new, m))


def _feistel(cells: Column, key: str, kind: str, restore: bool) -> Column:
    half = F.floor(F.size(cells) / 2).cast("int")
    halves = F.struct(
        F.slice(cells, F.lit(1), half).alias("l"), F.slice(cells, half + 1, F.size(cells) - half).alias("r")
    )

    def noise(other: Column, turn: Column, place: Column, radix: Column) -> Column:
        text = F.concat_ws(
            "|", F.lit(key), F.lit(kind), turn.cast("string"), F.array_join(F.transform(other, lambda c: c["v"].cast("string")), ","), place.cast("string")
        )
        return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint"), radix)

    def shifted(side: Column, other: Column, turn: Column, sign: int) -> Column:
        return F.transform(
            side,
            lambda c, j: F.struct(
                F.pmod(c["v"] + F.lit(sign) * noise(other, turn, j, c["m"]), c["m"]).alias("v"), c["m"].alias("m")
            ),
        )

    def forth(acc: Column, turn: Column) -> Column:
        return F.struct(acc["r"].alias("l"), shifted(acc["l"], acc["r"], turn, 1).alias("r"))

    def back(acc: Column, turn: Column) -> Column:
        return F.struct(shifted(acc["r"], acc["l"], turn, -1).alias("l"), acc["l"].alias("r"))

    turns = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if restore else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(turns, halves, back if restore else forth, lambda acc: F.concat(acc["l"], acc["r"]))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _is(c: Column, what: str) -> Column:
    return c.rlike(f"^[{what}]$")


def _char_cells(s: Column) -> Column:
    """Letters and digits of ``s``: each stays in its class."""
    return F.transform(
        _chars(s),
        lambda c: F.when(_is(c, "0-9"), _cell(F.ascii(c) - 48, 10))
        .when(_is(c, "a-z"), _cell(F.ascii(c) - 97, 26))
        .otherwise(_cell(F.ascii(c) - 65, 26)),
    )


def _spelled(cells: Column, like: Column) -> Column:
    """The cells' values as characters, in the places and classes of the letters and digits of ``like``."""
    return _let(cells, lambda c: _put(c, like))


def _put(cells: Column, like: Column) -> Column:
    def put(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substring(like, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
        v = F.element_at(cells, nth)["v"].cast("int")
        return (
            F.when(_is(c, "0-9"), F.char(v + 48)).when(_is(c, "a-z"), F.char(v + 97)).when(_is(c, "A-Z"), F.char(v + 65)).otherwise(c)
        )

    return F.array_join(F.transform(_chars(like), put), "")


def _alnum(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9A-Za-z]", "")


def _permuted(s: Column, key: str, kind: str, restore: bool) -> Column:
    return _spelled(feistel(_char_cells(_alnum(s)), key, kind, restore), s)


def _digits(s: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(s, "[^0-9]", "")), lambda c: c.cast("int"))


def _luhn(digits: Column, first_doubled: int) -> Column:
    """Luhn sum; of the digits from the right, every second one from ``first_doubled`` counts double."""
    terms = F.transform(
        F.reverse(digits),
        lambda d, i: F.when((i % 2) == first_doubled, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d),
    )
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x)


def _mod97(s: Column) -> Column:
    step = lambda a, c: F.when(_is(c, "0-9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(_chars(s), F.lit(0), lambda a, c: step(a, c).cast("int"))


def _card(s: Column, key: str, restore: bool) -> Column:
    """The first digit stays (it names the network), the last one is the check digit."""
    n = F.length(F.regexp_replace(s, "[^0-9]", ""))
    digits = F.regexp_replace(s, "[^0-9]", "")
    body = feistel(_char_cells(digits.substr(F.lit(2), n - 2)), key, "card", restore)
    kept = F.concat(F.array(_cell(digits.substr(1, 1).cast("int"), 10)), body)

    def checked(cells: Column) -> Column:
        check = F.pmod(-_luhn(F.transform(cells, lambda c: c["v"].cast("int")), 0), F.lit(10))
        return F.concat(cells, F.array(_cell(check, 10)))

    return _spelled(_let(kept, checked), s)


def _iban(s: Column, key: str, restore: bool) -> Column:
    bban, land = s.substr(F.lit(5), F.length(s) - 4), s.substr(1, 2)

    def checked(new: Column) -> Column:
        return F.concat(land, F.lpad((98 - _mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0"), new)

    return _let(_permuted(bban, key, "iban", restore), checked)


def _date_of(s: Column) -> Column:
    iso = s.substr(5, 1).isin("-", "/")
    return F.when(iso, F.try_to_date(F.regexp_replace(s, "/", "-"), "yyyy-MM-dd")).otherwise(F.try_to_date(F.regexp_replace(s, r"[./]", "-"), "dd-MM-yyyy"))


def _date(s: Column, key: str, restore: bool) -> Column:
    n = F.datediff(_date_of(s), F.lit(FIRST_DAY).cast("date"))
    rows, cols = DAY_CELLS
    cells = feistel(F.array(_cell(F.floor(n / cols), rows), _cell(n % cols, cols)), key, "date", restore)
    day_of = lambda c: F.date_add(F.lit(FIRST_DAY).cast("date"), (c[0]["v"] * cols + c[1]["v"]).cast("int"))

    def written(day: Column) -> Column:
        return (
            F.when(s.substr(5, 1) == "-", F.date_format(day, "yyyy-MM-dd"))
            .when(s.substr(5, 1) == "/", F.date_format(day, "yyyy/MM/dd"))
            .when(s.substr(3, 1) == ".", F.date_format(day, "dd.MM.yyyy"))
            .otherwise(F.date_format(day, "dd/MM/yyyy"))
        )

    return _let(_let(cells, day_of), written)


def _ip(s: Column, key: str, restore: bool) -> Column:
    cells = feistel(F.transform(F.split(s, r"\."), lambda o: _cell(o.cast("int"), 256)), key, "ip", restore)
    return F.array_join(F.transform(cells, lambda c: c["v"].cast("string")), ".")


def _phone(s: Column, key: str, restore: bool) -> Column:
    """The last ten digits; area codes from 200 and those below are permuted apart, the country code stays."""
    digits = F.regexp_replace(s, "[^0-9]", "")
    ten = F.substring(digits, -10, 10)
    low = F.substring(ten, 1, 1) < "2"
    first = lambda c: F.when(low, _cell(c, 2)).otherwise(_cell(c - 2, 8))
    cells = F.transform(_chars(ten), lambda c, i: F.when(i == 0, first(c.cast("int"))).otherwise(_cell(c.cast("int"), 10)))
    new = F.transform(feistel(cells, key, "phone", restore), lambda c, i: _cell(c["v"] + F.when((i == 0) & ~low, 2).otherwise(0), 10))
    return _spelled(F.concat(_char_cells(digits.substr(F.lit(1), F.length(digits) - 10)), new), s)


def _abroad(s: Column, key: str, restore: bool) -> Column:
    """A number with another country code: its first two digits stay."""
    return F.concat(s.substr(1, 3), _permuted(F.substring(s, F.lit(4), F.length(s)), key, "abroad", restore))


def _email(s: Column, key: str, restore: bool) -> Column:
    """The local part; the domain stays."""
    local = F.substring_index(s, "@", 1)
    return F.concat(_permuted(local, key, "email", restore), F.substring(s, F.length(local) + 1, F.length(s)))


def _kind(s: Column) -> Column:
    """The kind of a found span; null if it is not valid and must stay."""
    only = lambda k: s.rlike(f"^(?:{PATTERNS[k]})$")
    days = F.datediff(_date_of(s), F.lit(FIRST_DAY).cast("date"))  # null: no such day
    octets = F.forall(F.split(s, r"\."), lambda o: o.rlike("^(?:0|[1-9][0-9]{0,2})$") & (o.cast("int") < 256))
    return (
        F.when(only("email"), F.lit("email"))
        .when(only("access_key"), F.lit("access_key"))
        .when(s.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(~s.rlike("^(?:000|666|9)|-00-|0000$"), F.lit("ssn")))
        .when(only("date"), F.when((days >= 0) & (days < DAY_CELLS[0] * DAY_CELLS[1]), F.lit("date")))
        .when(only("ip"), F.when(octets, F.lit("ip")))
        .when(only("abroad"), F.lit("abroad"))
        .when(only("phone"), F.lit("phone"))
        .when(s.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), F.when(_mod97(F.concat(s.substr(F.lit(5), F.length(s) - 4), s.substr(1, 4))) == 1, F.lit("iban")))
        .when(only("card"), F.when((F.pmod(_luhn(_digits(s), 1), F.lit(10)) == 0), F.lit("card")))
        .otherwise(F.when(s.rlike("^[A-Za-z0-9]{6,}$"), F.lit("secret")))
    )


def _ssn(s: Column, key: str, restore: bool) -> Column:
    """Area 001-899 without 666 (898 values), group 01-99, serial 0001-9999: the valid numbers are permuted among themselves."""
    area = s.substr(1, 3).cast("int")
    cells = F.array(
        _cell(area - 1 - F.when(area > 666, 1).otherwise(0), 898),
        _cell(s.substr(5, 2).cast("int") - 1, 99),
        _cell(s.substr(8, 4).cast("int") - 1, 9999),
    )
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")

    def written(new: Column) -> Column:
        a = new[0]["v"] + 1 + F.when(new[0]["v"] >= 665, 1).otherwise(0)
        return F.concat_ws("-", pad(a, 3), pad(new[1]["v"] + 1, 2), pad(new[2]["v"] + 1, 4))

    return _let(feistel(cells, key, "ssn", restore), written)


def pseudonym(s: Column, kind: Column, key: str, restore: bool = False) -> Column:
    makers = {
        "email": _email,
        "date": _date,
        "ip": _ip,
        "abroad": _abroad,
        "phone": _phone,
        "ssn": _ssn,
        "iban": _iban,
        "card": _card,
        "secret": lambda c, k, r: _permuted(c, k, "secret", r),
        "access_key": lambda c, k, r: F.concat(c.substr(1, 4), _permuted(c.substr(5, 16), k, "access_key", r)),
    }
    cases = reduce(lambda w, item: w.when(kind == item[0], item[1](s, key, restore)), makers.items(), F.when(kind.isNull(), s))
    return cases


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text", restore: bool = False) -> DataFrame:
    """Every column of ``docs``, ``text_column`` replaced, and ``replaced``: array of (kind, place) in text order.

    ``place`` is the 1-based number of the span among all spans found. A null text stays null (replaced: empty array);
    an empty text or one without spans stays as it is. Rows are independent: repeated rows give equal results, other
    columns and null ids pass through, also a column named ``replaced`` is replaced. An empty table gives no rows.
    Spans that fail validation stay. Letters outside A-Z and the domain of an address stay.
    """
    text = F.col(text_column)
    marked = text.rlike('[0-9@]|AKIA|ASIA|(?i:password|token = ")')
    found = F.when(marked, F.regexp_extract_all(text, F.lit(SPAN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    spans = F.transform(found, lambda s: F.struct(s.alias("s"), _kind(s).alias("kind")))
    new = F.transform(
        F.col("_spans"), lambda x: F.struct(pseudonym(x["s"], x["kind"], key, restore).alias("s"), x["kind"].alias("kind"))
    )
    parts = F.split(text, SPAN, -1)
    whole = F.array_join(
        F.zip_with(parts, F.col("_new"), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b["s"], F.lit("")))), ""
    )
    tagged = F.transform(F.col("_new"), lambda x, i: F.struct(x["kind"].alias("kind"), (i + 1).alias("place")))
    return (
        docs.withColumn("_spans", F.coalesce(spans, F.array().cast("array<struct<s:string,kind:string>>")))
        .withColumn("_new", F.when(F.size("_spans") > 0, new))
        .withColumn("replaced", F.coalesce(F.filter(tagged, lambda x: x["kind"].isNotNull()), F.array().cast("array<struct<kind:string,place:int>>")))
        .withColumn(text_column, F.when(F.col("_new").isNotNull(), whole).otherwise(text))
        .drop("_spans", "_new")
    )
