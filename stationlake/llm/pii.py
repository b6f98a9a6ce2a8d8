"""Format-preserving pseudonyms for personal data.

Numbers and dates that pass the checks of their kind are permuted among all valid values of the
same format by a keyed Feistel network, so a pseudonym is as valid as the original, equal values
get equal pseudonyms in all documents, and different values of a kind different ones. The network
works on pairs (l, r) of residues: a round adds a keyed hash of one half to the other, modulo the
number of its values, so any domain of a * b values is permuted without trial and error.

| kind | checks | permuted |
| --- | --- | --- |
| card | 13 to 19 digits in whole groups, Luhn | digits after the first; the last is the new check digit |
| iban | the country's length, mod 97 | digits after the check digits, which are new |
| ssn | area, group and serial ranges | all three parts |
| phone | international or North American form | digits after the country code |
| ip | four numbers to 255 | all 32 bits |
| date | a day of the calendar | the day within its 400-year cycle |

E-mail addresses and secrets (keys, passwords and tokens) have no such domain; they get keyed
hashes, secrets of the same length. Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import fresh, let

ROUNDS = 8
MARK, ESCAPE = "\u0001m", "\u0001e"

# The forms in which the kinds are written. None begins or ends inside a word.
START, END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*"
    r"(?<=\.[A-Za-z]{2,24})",
    "access": START + r"(?:AKIA|ASIA)[0-9A-Z]{16}" + END,
    "secret": START + r"(?i:password|passwd|pwd|token|secret|api[_-]?key)[ \t]{0,3}[=:]"
    r"[ \t]{0,3}[\"']?[^\s\"'(),;]{6,}+",
    "ip": r"(?<![0-9A-Za-z.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?![0-9A-Za-z]|\.[0-9])",
    "iso": START + r"[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}" + END,
    "dotted": START + r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}" + END,
    "slashed": START + r"[0-9]{2}/[0-9]{2}/[0-9]{4}" + END,
    "ssn": START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END,
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?!\.[0-9])" + END,
    "card": "",
}
#: The lengths of IBANs by country, those in use outside the registry included.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_form() -> str:
    """IBANs in one group or groups of four, of their country's length.

    Those of other countries have any length, as far as letters and digits go.
    """
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        spaced = "(?: [0-9A-Z]{4}){%d}" % fours + (" [0-9A-Z]{%d}" % rest if rest else "")
        heads = "|".join(countries.split())
        forms.append(f"(?:{heads})[0-9]{{2}}(?:[0-9A-Z]{{{length - 4}}}|{spaced})")
    known = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    forms.append(
        f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:[0-9A-Z]{{11,30}}"
        r"|(?: (?![A-Z]{2}[0-9]{2} )[0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)"
    )
    return START + "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(forms) + ")" + END


# A card's form is a whole run of groups of digits, up to a group that begins another form; which
# of its groups are cards is found out later. Loops are possessive, as others nest for each group.
GROUP = r"[0-9]++(?![0-9A-Za-z]|\.[0-9])"
OTHER = "|".join(FORMS[k] for k in ("email", "ip", "iso", "dotted", "slashed", "ssn", "phone"))
FORMS["card"] = (
    r"(?<![0-9A-Za-z-])(?<![0-9]\.)(?=[0-9](?:[ -]?[0-9]){12})"
    + GROUP
    + f"(?:[ -](?!{OTHER}){GROUP})*+"
)
FORMS["iban"] = _iban_form()
#: The numbers of digits of a card, and the groups in which cards are usually written; what has
#: such groups comes before other runs of groups, and the first of them before the later.
CARD_SIZES = range(13, 20)
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (6, 13), (4, 3, 3, 3), (4, 4, 5))
# a row without any of these has none of the forms
HINT = r"[0-9@=]|AKIA|ASIA|(?i:password|passwd|pwd|token|secret|key)[ \t]{0,3}:"
#: Days of the 400 years after which the calendar repeats: 189 * 773.
CYCLE = (189, 773)
CYCLE_START = "1800-01-01"


def any_form() -> str:
    """One pattern for all forms, in the order in which they are tried."""
    form = "|".join(FORMS.values())
    return f"({form})"


def _hash(key: str, *values: Column) -> Column:
    """52 keyed bits."""
    text = F.concat_ws("|", F.lit(key), *[v.cast("string") for v in values])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")


def feistel(
    left: Column, right: Column, a: Column | int, b: Column | int, key: str, tweak: Column
) -> Column:
    """The pair (l, r) of residues modulo ``a`` and ``b``, permuted by key and tweak.

    All arguments are bigint or int columns; the result is struct<l bigint, r bigint>.
    """
    a, b = (x if isinstance(x, Column) else F.lit(x) for x in (a, b))
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        moved_l = F.pmod(s["l"] + _hash(key, tweak, i, s["r"]), a).cast("bigint")
        moved_r = F.pmod(s["r"] + _hash(key, tweak, i, s["l"]), b).cast("bigint")
        return F.struct(
            F.when(odd, s["l"]).otherwise(moved_l).alias("l"),
            F.when(odd, moved_r).otherwise(s["r"]).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def permute_digits(digits: Column, key: str, tweak: Column) -> Column:
    """A string of up to 36 digits, permuted among all of its length."""

    def halves(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        return F.struct(
            F.coalesce(F.substring(d, F.lit(1), u).try_cast("bigint"), F.lit(0)).alias("l"),
            F.coalesce(F.substring(d, u + 1, n).try_cast("bigint"), F.lit(0)).alias("r"),
            u.alias("u"),
            (n - u).alias("v"),
        )

    def moved(h: Column) -> Column:
        a = F.pow(F.lit(10.0), h["u"]).cast("bigint")
        b = F.pow(F.lit(10.0), h["v"]).cast("bigint")
        return let(
            feistel(h["l"], h["r"], a, b, key, F.concat_ws("/", tweak, h["u"], h["v"])),
            lambda x: F.concat(
                F.when(h["u"] > 0, _padded(x["l"], h["u"])).otherwise(""), _padded(x["r"], h["v"])
            ),
        )

    return let(let(digits, halves), moved)


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order by those of a string."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        new = F.when(is_digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(s["out"], new).alias("out"),
            (s["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(_characters(form), start, put)["out"]


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, the last one counted once."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(places, F.lit(0), add)


def _window(size: int) -> str:
    """So many digits with what may stand between them, marks included."""
    return r"[0-9](?:[A-Za-z -]*[0-9]){%d}" % (size - 1)


def card_parts(run: Column) -> Column:
    """A run of groups of digits in parts, of which every second one is a card.

    A card is some whole groups that pass the checks. In a first turn cards in one group or the
    usual groups are taken, from the left; in a second one any groups between them, the longest
    first. Each group is marked by a letter for the number of digits of the card that begins
    there: a small one for the first turn, and a capital one for the second.
    """

    def mark(forms: list[tuple[str, int]], tail: Column, valid: Column, first: str) -> Column:
        found = [
            F.when(
                F.array_contains(valid, size) & tail.rlike(f"^(?:{form})(?![0-9])"),
                F.lit(chr(ord(first) + size)),
            )
            for form, size in forms
        ]
        return F.coalesce(*found, F.lit(""))

    def checked(digits: Column) -> Column:
        """The numbers of digits that give a right check digit."""
        every = F.array(*[F.lit(n) for n in CARD_SIZES])

        def right(n: Column) -> Column:
            return (n <= F.length(digits)) & (luhn_sum(F.substring(digits, F.lit(1), n)) % 10 == 0)

        return F.filter(every, right)

    usual = [("[0-9]{%d}" % n, n) for n in CARD_SIZES]
    for sizes in CARD_GROUPS:
        # one separator throughout
        rest = "".join(("([ -])" if i == 0 else r"\1") + "[0-9]{%d}" % n for i, n in enumerate(sizes[1:]))
        usual.append(("[0-9]{%d}" % sizes[0] + rest, sum(sizes)))
    loose = [(_window(n), n) for n in reversed(CARD_SIZES)]

    def marked(tail: Column) -> Column:
        return let(
            let(_only_digits(tail), checked),
            lambda valid: F.concat(mark(usual, tail, valid, "a"), mark(loose, tail, valid, "A")),
        )

    # every group with all that follows it, as far as a card and the next digit can go
    tails = F.regexp_extract_all(run, F.lit("(?<![0-9])(?=([0-9](?:[ -]?[0-9]){0,19}))"), F.lit(1))
    groups = F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), F.lit(0))
    whole = F.array_join(F.zip_with(tails, groups, lambda t, g: F.concat(marked(t), g)), "")
    # the mark of the second turn follows that of the first
    one = "|".join(chr(ord("a") + n) + "[A-Z]?" + _window(n) for n in CARD_SIZES)
    two = "|".join(chr(ord("A") + n) + _window(n) for n in CARD_SIZES)
    first = F.regexp_replace(whole, one, "<$0>")
    second = F.regexp_replace(first, f"<[^>]*+>|{two}", "<$0>")
    return F.split(F.regexp_replace(second, "[A-Za-z]", ""), "[<>]+", -1)


def _card(text: Column, key: str) -> Column:
    def moved(d: Column) -> Column:
        n = F.length(d)
        first = F.substring(d, F.lit(1), F.lit(1))
        body = permute_digits(F.substring(d, F.lit(2), n - 2), key, F.concat(F.lit("card"), first))
        whole = F.concat(first, body)
        short = let(F.concat(whole, F.lit("0")), luhn_sum)
        check = F.pmod(10 - short % 10, F.lit(10)).cast("string")
        return F.when(luhn_sum(d) % 10 == 0, F.concat(whole, check))

    return let(let(_only_digits(text), moved), lambda d: F.coalesce(fill(text, d), text))


def _mod97(text: Column) -> Column:
    """An IBAN's remainder, its first four characters moved to the end."""
    turned = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(_characters(turned), F.lit(0), add)


def _iban(text: Column, key: str) -> Column:
    def moved(t: Column) -> Column:
        head, tail = F.substring(t, F.lit(1), F.lit(2)), F.substring(t, F.lit(5), F.length(t))
        shape = F.concat(head, F.regexp_replace(tail, "[0-9]", "0"))
        body = fill(tail, permute_digits(_only_digits(tail), key, F.concat(F.lit("iban"), shape)))
        check = let(body, lambda b: _padded(98 - _mod97(F.concat(head, F.lit("00"), b)), 2))
        valid = (_mod97(t) == 1) & (F.length(_only_digits(tail)) > 0)
        return F.when(valid, F.concat(check, _only_digits(body)))

    plain = let(F.replace(text, F.lit(" "), F.lit("")), moved)
    return let(plain, lambda d: F.coalesce(fill(text, d), text))


def _ssn(text: Column, key: str) -> Column:
    area, group, serial = (
        F.substring(text, F.lit(i), F.lit(n)).cast("int") for i, n in ((1, 3), (5, 2), (8, 4))
    )
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    left = area - 1 - (area > 666).cast("int")
    right = (group - 1).cast("bigint") * 9999 + serial - 1

    def moved(x: Column) -> Column:
        new_area = x["l"] + 1 + (x["l"] >= 665).cast("int")
        new_group, new_serial = F.floor(x["r"] / 9999) + 1, x["r"] % 9999 + 1
        return F.concat_ws("-", _padded(new_area, 3), _padded(new_group, 2), _padded(new_serial, 4))

    return F.when(
        valid, let(feistel(left, right, 898, 99 * 9999, key, F.lit("ssn")), moved)
    ).otherwise(text)


def _phone(text: Column, key: str) -> Column:
    # the code of the country: what follows the plus sign, up to the first separator
    code = F.regexp_extract(text, r"^\+([0-9]{1,3})(?=[ .(-])", 1)
    rest = F.substring(_only_digits(text), F.length(code) + 1, F.length(text))

    def moved(d: Column) -> Column:
        area, exchange = (F.substring(d, F.lit(i), F.lit(3)).cast("int") for i in (1, 4))
        line = F.substring(d, F.lit(7), F.lit(4)).cast("int")
        american = (F.length(d) == 10) & code.isin("", "1") & (area > 199) & (exchange > 199)
        right = (exchange - 200).cast("bigint") * 10_000 + line
        pair = feistel(area - 200, right, 800, 8_000_000, key, F.lit("phone"))
        return F.when(
            american,
            let(
                pair,
                lambda x: F.concat(_padded(x["l"] + 200, 3), _padded(x["r"] + 2_000_000, 7)),
            ),
        ).otherwise(permute_digits(d, key, F.concat(F.lit("phone"), code)))

    return let(let(rest, moved), lambda d: fill(text, F.concat(code, d)))


def _ip(text: Column, key: str) -> Column:
    def moved(parts: Column) -> Column:
        o = [F.get(parts, F.lit(i)).cast("bigint") for i in range(4)]
        pair = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65_536, 65_536, key, F.lit("ip"))

        def dotted(x: Column) -> Column:
            octets = [o for h in "lr" for o in (F.floor(x[h] / 256), x[h] % 256)]
            return F.concat_ws(".", *[o.cast("string") for o in octets])

        return let(pair, dotted)

    return let(F.split(text, r"\."), moved)


def _day(text: Column, form: str) -> Column:
    return F.try_to_date(text, form)


def _permute_day(day: Column, key: str, tweak: Column) -> Column:
    """Another day of the same 400 years."""
    a, b = CYCLE
    start = F.lit(CYCLE_START).cast("date")

    def moved(n: Column) -> Column:
        cycle = F.floor(n / (a * b)).cast("int")
        within = n - cycle * (a * b)
        # the tweak tells the cycles apart
        pair = feistel(
            F.floor(within / b), within % b, a, b, key, F.concat_ws("/", tweak, cycle)
        )
        return let(
            pair, lambda x: F.date_add(start, (cycle * (a * b) + x["l"] * b + x["r"]).cast("int"))
        )

    return let(F.datediff(day, start), moved)


def _date(text: Column, form: str, key: str) -> Column:
    kind = F.lit(f"date {form}")
    new = let(_day(text, form), lambda d: F.date_format(_permute_day(d, key, kind), form))
    return F.when(_day(text, form).isNotNull(), new)


def _month_first(text: Column, key: str) -> Column:
    """Dates that can only be read month first, permuted among these.

    The permutation of all days is walked until it meets such a date again, which is also a
    permutation. Three in five days are such, so 64 steps do not suffice once in 10^25 times.
    """
    form, kind = "MM/dd/yyyy", F.lit("date MM/dd/yyyy")

    def only(day: Column) -> Column:
        return F.day(day) > 12

    def step(state: Column, _: Column) -> Column:
        done = state["moved"] & only(state["day"])
        return F.when(done, state).otherwise(
            F.struct(F.lit(True).alias("moved"), _permute_day(state["day"], key, kind).alias("day"))
        )

    def walk(day: Column) -> Column:
        start = F.struct(F.lit(False).alias("moved"), day.alias("day"))
        end = F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, step)["day"]
        return F.date_format(end, form)

    return F.when(_day(text, form).isNotNull(), let(_day(text, form), walk))


def _email(text: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(text)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@mail.invalid"))


def _secret(text: Column, lead: str, key: str) -> Column:
    """The text with a keyed hash of the same length after its lead."""
    kept = F.regexp_extract(text, lead, 0)

    def moved(value: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), value), 256)
        n = F.length(value)
        return F.substring(F.repeat(digest, F.ceil(n / 64).cast("int")), F.lit(1), n)

    value = F.substring(text, F.length(kept) + 1, F.length(text))
    return F.concat(kept, let(value, moved))


def pseudonym(text: Column, key: str) -> Column:
    """The pseudonym of a text that has one of the forms; the text itself, if it is not valid."""

    def has(form: str) -> Column:
        return text.rlike(f"^(?:{FORMS[form]})$")

    slashed = F.coalesce(_date(text, "dd/MM/yyyy", key), _month_first(text, key), text)
    iso = F.coalesce(_date(text, "yyyy-MM-dd", key), _date(text, "yyyy/MM/dd", key), text)
    lead = r"^[^=:]*[=:][ \t]*[\"']?"
    return (
        F.when(text.contains("@") & has("email"), _email(text, key))
        .when(has("access"), F.upper(_secret(text, "^.{4}", key)))
        .when(has("secret"), _secret(text, lead, key))
        .when(has("ip"), _ip(text, key))
        .when(text.rlike(r"^[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}$"), iso)
        .when(has("dotted"), F.coalesce(_date(text, "dd.MM.yyyy", key), text))
        .when(has("slashed"), slashed)
        .when(has("ssn"), _ssn(text, key))
        .when(has("phone"), _phone(text, key))
        .when(text.rlike(f"^{_window(13)}(?:[ -]?[0-9]){{0,6}}$"), _card(text, key))
        .when(has("iban"), _iban(text, key))
        .otherwise(text)
    )


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", found: str | None = None
) -> DataFrame:
    """``docs`` with the personal data in each whole text replaced by pseudonyms.

    ``found`` names a column for the number of values replaced; a column of that name is
    replaced. Null texts stay null with 0 values; texts without personal data stay as they are,
    byte for byte. Rows are treated one by one, so repeats get equal texts, other columns stay,
    and an empty table stays empty. Values of a form that fail their checks stay.
    """
    whole = F.col(text)
    marked = F.regexp_replace(
        F.replace(whole, F.lit("\u0001"), F.lit(ESCAPE)), any_form(), f"{MARK}$0{MARK}"
    )
    parts = F.when(whole.rlike(HINT), F.split(marked, MARK, -1))
    own, fixed = fresh(), fresh()
    # every second part has a form; so it is when those of a run stand between two empty ones
    empty = F.array(F.lit(""))

    def cut(part: Column, i: Column) -> Column:
        run = (i % 2 == 1) & part.rlike("^[0-9](?:[ -]?[0-9]){12,}+$")
        several = let(part, lambda p: F.concat(empty, card_parts(p), empty))
        return F.when(run, several).otherwise(F.array(part))

    rows = docs.withColumn(own, F.flatten(F.transform(parts, cut))).withColumn(
        fixed,
        F.transform(own, lambda p, i: F.when(i % 2 == 1, pseudonym(p, key)).otherwise(p)),
    )
    joined = F.replace(F.array_join(fixed, ""), F.lit(ESCAPE), F.lit("\u0001"))
    changed = F.zip_with(own, fixed, lambda a, b: (a != b).cast("int"))
    count = F.aggregate(changed, F.lit(0), lambda s, x: s + x)
    new = {text: F.when(F.size(own) > 1, joined).otherwise(whole)}
    if found:
        new[found] = F.coalesce(count, F.lit(0))
    names = [*docs.columns, *(n for n in new if n not in docs.columns)]
    return rows.withColumns(new).select(*names)
