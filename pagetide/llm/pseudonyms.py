"""Format-preserving pseudonyms for personal numbers, dates and addresses in texts.

A value is found by its form, checked by its own rule (check digit, calendar, number plan), and
replaced by another valid value of the same form. The replacement is a keyed permutation of the
form's values: a Feistel network over the value's positions, each a number below its radix. In turn
one half of the positions is shifted by what a keyed SHA-256 makes of the other half. So equal
values stay equal in all documents, different ones stay different, and the key undoes it.

| kind | form | rule | what is permuted |
| --- | --- | --- | --- |
| email | local part at a domain | form | letters and digits of the local part |
| iban | two letters, two digits, 11 to 30 more | modulo 97 | digits of the account part |
| ip | four numbers | below 256 | all four |
| date | yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy | calendar, from 1900 on | the number of the day |
| ssn | ddd-dd-dddd | ranges that are issued | all three parts |
| card | 13 to 19 digits, also in groups | Luhn | all digits but the check digit |
| phone | ten digits in groups, as in North America | country code, brackets, or plan | area, exchange, line |

Numbers of the plan are permuted among themselves and other clear numbers among their own kind, so a
number gets one pseudonym however it is written. Host names have at most 127 labels of 63 characters,
as in the name system; this also bounds what the pattern engine keeps on its stack.

Only built-in functions are used. Defined results: null and empty texts stay as they are; what does
not pass its rule is left alone; a null `doc_id`, repeated rows and extra columns of any name are
kept; an empty table gives an empty result.
"""

from pyspark.sql import functions as F

from pagetide.llm.expressions import bound as _with

ROUNDS = 10
# Days are numbered from the first; 271 * 271 of them reach into January 2101.
FIRST_DAY, DAY_RADIX = "1900-01-01", 271

_START = r"(?<![\w.@-])"
_END = r"(?![\w@]|[.-]\w)"
EMAIL = r"(?=[A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,24}"
IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _END
IP = r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}" + _END
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + _END
POINT_DATE = r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}" + _END
SLASH_DATE = r"[0-9]{2}/[0-9]{2}/[0-9]{4}" + _END
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END
CARD = r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + _END
# A country code or an area in brackets says what it is; bare groups have to follow the plan.
CLEAR_PHONE = (
    r"(?:\+1[ .-]?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])|1?[ .-]?\([0-9]{3}\) ?)"
    + r"[0-9]{3}[ .-][0-9]{4}"
    + _END
)
PHONE = r"(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}" + _END
# In order of precedence where two forms begin at one place.
FORMS = (EMAIL, IBAN, IP, ISO_DATE, POINT_DATE, SLASH_DATE, SSN, CARD, CLEAR_PHONE, PHONE)
ANY = f"{_START}(?:{'|'.join(FORMS)})"


# Small texts as lists of characters and numbers.


def _characters(text):
    return F.filter(F.split(text, ""), lambda c: c != "")


def _only(text, characters):
    return F.regexp_replace(text, f"[^{characters}]", "")


def _numbers(digits):
    return F.transform(_characters(digits), lambda c: c.cast("int"))


def _text(numbers):
    return F.array_join(F.transform(numbers, lambda n: n.cast("string")), "")


def _group(text, pattern, group):
    """A number in a text; only asked of texts that match."""
    return F.regexp_extract(text, pattern, group).cast("int")


def _refill(template, characters, filling):
    """The template with its characters of a class replaced, one by one, by those of `filling`."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("used"))

    def step(state, c):
        is_open = c.rlike(f"^[{characters}]$")
        taken = F.substr(filling, state["used"] + 1, F.lit(1))
        return F.struct(
            F.concat(state["done"], F.when(is_open, taken).otherwise(c)).alias("done"),
            (state["used"] + F.when(is_open, 1).otherwise(0)).alias("used"),
        )

    return F.aggregate(_characters(template), start, step, lambda state: state["done"])


def _luhn(digits):
    """The Luhn sum modulo ten of digits that end with a check digit."""
    weighed = F.transform(
        F.reverse(_numbers(digits)),
        lambda n, at: F.when(at % 2 == 0, n).when(n > 4, n * 2 - 9).otherwise(n * 2),
    )
    return F.aggregate(weighed, F.lit(0), lambda total, n: total + n) % 10


def _modulo_97(text):
    """A text as a number in which letters are 10 to 35, modulo 97."""
    codes = F.transform(_characters(text), lambda c: F.conv(c, 36, 10).cast("int"))
    return F.aggregate(
        codes,
        F.lit(0),
        lambda rest, n: F.when(n < 10, (rest * 10 + n) % 97).otherwise((rest * 100 + n) % 97),
    )


# The permutation.


def _shift(prefix, at, other):
    """A number that depends on the key, the kind and the round, the place, and the other half."""
    parts = F.concat_ws("|", prefix, at.cast("string"), other)
    return F.conv(F.substring(F.sha2(parts, 256), 1, 13), 16, 10).cast("bigint")


def _permuted(positions, key, kind, undo=False):
    """The values after all rounds. `positions` are structs of `value` and `radix` above it."""

    def halves(known):
        half = F.ceil(F.size(known) / 2).cast("int")
        rest = F.size(known) - half
        return F.struct(
            F.slice(known, F.lit(1), half).alias("left"),
            F.slice(known, half + 1, rest).alias("right"),
        )

    def moved(half, other, turn):
        seen = F.array_join(F.transform(other, lambda one: one["value"].cast("string")), ",")
        prefix = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"))

        def shifted(context):
            def one(position, at):
                by = _shift(context["prefix"], at, context["seen"])
                value = position["value"] - by if undo else position["value"] + by
                return _position(F.pmod(value, position["radix"]), position["radix"])

            return F.transform(half, one)

        return _with(F.struct(prefix.alias("prefix"), seen.alias("seen")), shifted)

    def step(state, turn):
        left, right = state["left"], state["right"]
        return F.when(
            turn % 2 == 1, F.struct(moved(left, right, turn).alias("left"), right.alias("right"))
        ).otherwise(F.struct(left.alias("left"), moved(right, left, turn).alias("right")))

    turns = F.sequence(F.lit(ROUNDS), F.lit(1)) if undo else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(
        turns,
        _with(positions, halves),
        step,
        lambda state: F.transform(
            F.concat(state["left"], state["right"]), lambda one: one["value"]
        ),
    )


def _position(value, radix):
    return F.struct(value.cast("int").alias("value"), radix.cast("int").alias("radix"))


def _same_radix(values, radix):
    return F.transform(values, lambda value: _position(value, F.lit(radix)))


def _fixed(kind, values, radixes, settings):
    """Permuted values of a form with a few positions of known radixes."""
    positions = [_position(value, F.lit(radix)) for value, radix in zip(values, radixes)]
    return _permuted(F.array(*positions), kind=kind, **settings)


def _padded(number, width):
    return F.lpad(number.cast("string"), width, "0")


# One function per kind: the replacement, or null where the value fails its rule.


def _letter_positions(letters):
    return F.transform(
        letters,
        lambda c: F.when(c.rlike("[0-9]"), _position(F.ascii(c) - 48, F.lit(10)))
        .when(c.rlike("[A-Z]"), _position(F.ascii(c) - 65, F.lit(26)))
        .otherwise(_position(F.ascii(c) - 97, F.lit(26))),
    )


def _letter(old, value):
    """The character of a value, of the same class as the old one."""
    first = F.when(old.rlike("[0-9]"), 48).when(old.rlike("[A-Z]"), 65).otherwise(97)
    return F.char(first + value)


def _email(found, settings):
    local = F.substring_index(found, "@", 1)
    new = _with(
        _characters(_only(local, "A-Za-z0-9")),
        lambda letters: F.array_join(
            F.zip_with(
                letters, _permuted(_letter_positions(letters), kind="email", **settings), _letter
            ),
            "",
        ),
    )
    changed = _with(new, lambda filling: _refill(local, "A-Za-z0-9", filling))
    return F.concat(changed, F.lit("@"), F.substring_index(found, "@", -1))


def _iban(found, settings):
    plain = _only(found, "A-Z0-9")
    country, account = F.substring(plain, 1, 2), F.substring(plain, 5, 30)
    valid = _modulo_97(F.concat(account, F.substring(plain, 1, 4))) == 1
    digits = _same_radix(_numbers(_only(account, "0-9")), 10)

    def whole(new):
        check = 98 - _modulo_97(F.concat(new, country, F.lit("00")))
        return F.concat(country, _padded(check, 2), new)

    new = _with(
        _text(_permuted(digits, kind="iban", **settings)),
        lambda filling: _refill(account, "0-9", filling),
    )
    refilled = _with(_with(new, whole), lambda filling: _refill(found, "A-Z0-9", filling))
    return F.when(valid & (F.size(digits) > 1), refilled)


def _ip(found, settings):
    parts = F.transform(F.split(found, r"\."), lambda part: part.cast("int"))
    new = _permuted(_same_radix(parts, 256), kind="ip", **settings)
    valid = F.forall(parts, lambda part: part < 256)
    return F.when(valid, F.array_join(F.transform(new, lambda n: n.cast("string")), "."))


def _date(written, kind):
    def replace(found, settings):
        first = F.to_date(F.lit(FIRST_DAY))
        number = F.datediff(F.try_to_timestamp(found, F.lit(written)).cast("date"), first)
        values = [F.floor(number / DAY_RADIX), number % DAY_RADIX]

        def day(new):
            days = F.get(new, F.lit(0)) * DAY_RADIX + F.get(new, F.lit(1))
            return F.date_format(F.date_add(first, days), written)

        changed = _with(_fixed(kind, values, [DAY_RADIX] * 2, settings), day)
        return F.when(number.between(0, DAY_RADIX**2 - 1), changed)

    return replace


def _ssn(found, settings):
    area, group, serial = (_group(found, "^(...)-(..)-(....)$", n) for n in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area < 666, area - 1).otherwise(area - 2)

    def written(new):
        number = F.get(new, F.lit(0))
        return F.concat_ws(
            "-",
            _padded(F.when(number < 665, number + 1).otherwise(number + 2), 3),
            _padded(F.get(new, F.lit(1)) + 1, 2),
            _padded(F.get(new, F.lit(2)) + 1, 4),
        )

    new = _fixed("ssn", [place, group - 1, serial - 1], [898, 99, 9999], settings)
    return F.when(valid, _with(new, written))


def _card(found, settings):
    digits = _only(found, "0-9")
    # Zeros alone pass Luhn and are nobody's number.
    valid = (_luhn(digits) == 0) & ~digits.rlike("^0+$")
    body = _same_radix(_numbers(F.regexp_replace(digits, ".$", "")), 10)

    def checked(new):
        check = (10 - _luhn(F.concat(new, F.lit("0")))) % 10
        return F.concat(new, check.cast("string"))

    new = _with(_text(_permuted(body, kind="card", **settings)), checked)
    return F.when(valid, _with(new, lambda filling: _refill(found, "0-9", filling)))


# Areas and exchanges are below this in numbers outside the plan, one of them at least.
_PLAN = 200


def _permuted_phone(area, exchange, line, settings):
    """The new parts of a number, among the numbers of its kind: kinds do not meet."""
    low, high = (0, _PLAN), (_PLAN, 1000 - _PLAN)

    def among(kind, areas, exchanges):
        values = [area - areas[0], exchange - exchanges[0], line]
        new = _fixed(kind, values, [areas[1], exchanges[1], 10_000], settings)
        return _with(
            new,
            lambda found: F.array(
                F.get(found, F.lit(0)) + areas[0],
                F.get(found, F.lit(1)) + exchanges[0],
                F.get(found, F.lit(2)),
            ),
        )

    return (
        F.when(area < _PLAN, among("phone of low area", low, (0, 1000)))
        .when(exchange < _PLAN, among("phone of low exchange", high, low))
        .otherwise(among("plan phone", high, high))
    )


def _phone(plan_only):
    """Ten digits; a leading 1 stays."""

    def replace(found, settings):
        digits = _only(found, "0-9")
        pattern = "^(1?)(...)(...)(....)$"
        area, exchange, line = (_group(digits, pattern, n) for n in (2, 3, 4))

        def written(new):
            filling = F.concat(
                F.regexp_extract(digits, pattern, 1),
                _padded(F.get(new, F.lit(0)), 3),
                _padded(F.get(new, F.lit(1)), 3),
                _padded(F.get(new, F.lit(2)), 4),
            )
            return _with(filling, lambda known: _refill(found, "0-9", known))

        valid = (area >= _PLAN) & (exchange >= _PLAN) if plan_only else area.isNotNull()
        return F.when(
            valid, _with(_permuted_phone(area, exchange, line, settings), written)
        )

    return replace


KINDS = (
    ("email", EMAIL, _email),
    ("iban", IBAN, _iban),
    ("ip", IP, _ip),
    ("date", ISO_DATE, _date("yyyy-MM-dd", "iso date")),
    ("date", POINT_DATE, _date("dd.MM.yyyy", "point date")),
    ("date", SLASH_DATE, _date("MM/dd/yyyy", "slash date")),
    ("ssn", SSN, _ssn),
    ("card", CARD, _card),
    ("phone", CLEAR_PHONE, _phone(plan_only=False)),
    ("phone", PHONE, _phone(plan_only=True)),
)


def _replacement(found, settings):
    """What was found, its kind and its replacement; the last two null where no rule accepts it."""
    tried = F.lit(None).cast("struct<kind:string,new:string>")
    for name, form, replace in reversed(KINDS):
        changed = F.struct(F.lit(name).alias("kind"), replace(found, settings).alias("new"))
        tried = F.when(found.rlike(f"^(?:{form})$"), changed).otherwise(tried)
    return _with(
        tried,
        lambda result: F.struct(
            found.alias("found"),
            F.when(result["new"].isNotNull(), result["kind"]).alias("kind"),
            result["new"].alias("new"),
        ),
    )


def _replaced(docs, key, undo=False):
    """Rows of `docs` whole, as `row`, with the new `text` and `kinds`, what was replaced in order."""
    settings = {"key": key, "undo": undo}
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    # Every form has an at sign, or two digits with a point between them at most.
    may_hold = F.col("text").rlike(r"@|[0-9]\.?[0-9]")
    present = F.coalesce(may_hold & F.col("text").rlike(ANY), F.lit(False))
    found = F.when(present, F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    marked = rows.withColumn("found", found)
    # A generator keeps the replacements from being worked out once per use.
    replaced = F.transform("found", lambda one: _replacement(one, settings))
    marked = marked.withColumn("values", F.explode(F.array(replaced)))
    between = F.split("text", ANY, -1)
    values = F.concat(
        F.transform("values", lambda one: F.coalesce(one["new"], one["found"])),
        F.array(F.lit("")),
    )
    whole = F.array_join(F.zip_with(between, values, lambda text, value: F.concat(text, value)), "")
    kinds = F.array_compact(F.transform("values", lambda one: one["kind"]))
    return marked.select(
        "row",
        F.when(F.col("found").isNotNull(), whole).otherwise(F.col("text")).alias("text"),
        F.coalesce(kinds, F.array().cast("array<string>")).alias("kinds"),
    )


def pseudonymised(docs, key, undo=False):
    """The documents with values in `text` replaced, and `kinds`, what was replaced in order.

    A column `kinds` of the documents gives way. The key is a secret: whoever has it can undo this.
    """
    others = [name for name in docs.columns if name not in ("text", "kinds")]
    own = [F.col("row")[name].alias(name) for name in others]
    return _replaced(docs, key, undo).select(*own, "text", "kinds")


def pseudonymised_documents(docs, key):
    """The documents with their own columns; `n_chars`, where it is one, follows a changed text."""
    changed = F.when(F.size("kinds") > 0, F.char_length("text").cast("bigint"))

    def column(name):
        if name == "text":
            return F.col("text")
        own = F.col("row")[name]
        return (F.coalesce(changed, own) if name == "n_chars" else own).alias(name)

    return _replaced(docs, key).select(*map(column, docs.columns))
