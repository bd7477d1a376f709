"""Format-preserving pseudonyms of personal data, with built-in SQL functions only.

One pattern finds candidates; each is validated (check digits, octets, calendar, number plans) and replaced by
another valid value of its format. What stands beside a value does not hide it: a phone number ends where its length
does, an IBAN where its country's does, and in a run of digit groups that is no card number as a whole the shorter
runs of groups are tried (all but the last of three digits at least). Numbers and dates go through a keyed Feistel network over exactly the domain of
their format: two parts in turn get a keyed digest of the other one added, modulo the part's size. That is a
permutation, so equal values become equal pseudonyms in every document and different values stay different. Check
digits are computed anew. E-mail names and secrets have no such domain; their characters are replaced, class by
class, by a keyed digest of the value.

| kind | validated by | permuted domain |
|---|---|---|
| card | 13 to 19 digits (blanks or hyphens in groups allowed), Luhn | all but the first and the check digit |
| iban | length, remainder 1 by 97 | the digits after the check digits; letters stay |
| ssn | area not 000, 666 or 9xx, group and serial not zero | areas x groups x serials |
| phone | "+", country code and 7 to 12 more digits | the digits after the country code (+1: area and exchange from 200) |
| ip | four octets | all addresses |
| date | calendar date, year first or last | the days of its century |

Dates with slashes are read day first unless only month first gives a date; the pseudonyms of both readings share one
form, so two such dates of different reading may meet.

A missing text stays missing; an empty one stays empty. Nothing else is changed in a text, and texts of any length
are treated whole. Rows that repeat are treated alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# IBAN lengths of the registry; a country that is not listed may have any.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG YE",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "(?:" + "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in IBAN_LENGTHS.items()
) + ")(?![A-Za-z0-9])"
# What ends a run of digit groups: a card number (for phones), or a value of another kind.
_CARD = r"[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{4,5}(?![0-9])"
_OTHER = (
    r"(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9-])"
    r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}(?![0-9])"
)


def _digits(least: int, most: int) -> str:
    """Digits of a phone number, in groups of two or more; none starts a card number or another value."""
    return f"(?:(?:(?! (?:{_CARD}|{_OTHER}))[ .-](?=[0-9]{{2}}))?[0-9]){{{least},{most}}}"


# Kinds in the order in which one place is tried. No pattern backtracks over more than one word.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    # The only capture but one: it tells secrets, which may look like anything, from the rest.
    "secret": r"((?:(?<=token = \")|(?<=token=)|(?<=password=)|(?<=secret=)|(?<=api_key=))[A-Za-z0-9]{12,}+"
    r"|(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9]))",
    "iban": r"(?<![A-Za-z0-9])(?:" + _IBANS + r"|(?!" + _IBANS + r")[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "phone": r"(?<![A-Za-z0-9+])\+(?:[0-9]{1,3}(?=[ .(-])(?:" + _digits(7, 12) + "|"
    + "|".join(rf"[ .-]?\([0-9]{{{n}}}\)" + _digits(7 - n, 12 - n) for n in range(1, 5))
    + r")|(?:1(?=[0-9]{3})|[02-9][0-9](?=[0-9]{2}))" + _digits(7, 12) + r")(?![0-9])",
    "ip": r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])",
    "date": r"(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?:(?=T[0-9])|(?![A-Za-z0-9/-]|\.[0-9]))"
    r"|[0-9]{1,2}([./])[0-9]{1,2}\2[0-9]{4}(?![A-Za-z0-9/-]|\.[0-9]))",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    # All groups of digits that follow each other, up to one that starts another value.
    "card": r"(?<![A-Za-z0-9.-])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z0-9])(?:(?:-| (?!" + _OTHER + r"))[0-9]++(?![A-Za-z0-9]))*+",
}
KINDS = tuple(PATTERNS)
# What tells the kinds of a match apart, taken by itself.
SHAPES = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@.*",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]+",
    "phone": r"\+[0-9 .()-]+",
    "ip": r"[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"[0-9][0-9 -]+",
}


def _pattern() -> str:
    """All kinds in one pattern; group 1 is filled by secrets only, group 2 is the separator of a date."""
    return "|".join(PATTERNS.values())


def _sql(pattern: str) -> str:
    return "r'" + pattern + "'"


class Pseudonyms:
    """SQL text of the replacement of one value, for a key. ``m`` names the value in all of it."""

    def __init__(self, key: str, rounds: int = ROUNDS):
        if "'" in key or "\\" in key:
            raise ValueError("the key must not hold quotes or backslashes")
        self.key, self.rounds = key, rounds

    def feistel(self, kind: str, a: str, b: str, size_a: str, size_b: str, then: str) -> str:
        """Permute the pair (a, b) below (size_a, size_b), and go on with ``then`` on ``s.a`` and ``s.b``."""
        add = lambda of: (
            f"cast(conv(substr(sha2(concat_ws('|', '{self.key}', '{kind}', i, {size_a}, {size_b}, {of}), 256), 1, 15), 16, 10) as bigint)"
        )
        return (
            f"aggregate(sequence(1, {self.rounds}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)),"
            f" (s, i) -> if(i % 2 = 1,"
            f" named_struct('a', (s.a + {add('s.b')} % cast({size_a} as bigint)) % cast({size_a} as bigint), 'b', s.b),"
            f" named_struct('a', s.a, 'b', (s.b + {add('s.a')} % cast({size_b} as bigint)) % cast({size_b} as bigint))),"
            f" s -> {then})"
        )

    def digits(self, kind: str, value: str) -> str:
        """Permute a string of 1 to 36 digits among those of its length."""
        u = f"cast(length({value}) div 2 as int)"
        v = f"(length({value}) - {u})"
        power = lambda n: f"cast(rpad('1', 1 + {n}, '0') as bigint)"
        number = lambda text: f"coalesce(cast(nullif({text}, '') as bigint), 0L)"
        return self.feistel(
            kind, number(f"left({value}, {u})"), number(f"right({value}, {v})"), power(u), power(v),
            f"concat(if({u} = 0, '', lpad(cast(s.a as string), {u}, '0')), lpad(cast(s.b as string), {v}, '0'))",
        )

    @staticmethod
    def let(name: str, value: str, body: str) -> str:
        """Compute a value once and name it in ``body``."""
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    @staticmethod
    def refill(shape: str, kind_of_digit: str, digits: str) -> str:
        """The shape with its digits replaced in order."""
        return (
            f"array_join(transform(split({shape}, ''), (c, at) -> if(c rlike '{kind_of_digit}',"
            f" substr({digits}, length(regexp_replace(left({shape}, at + 1), r'[^0-9]', '')), 1), c)), '')"
        )

    @staticmethod
    def luhn(digits: str) -> str:
        """Luhn sum of a string of digits."""
        return (
            f"aggregate(transform(split(reverse({digits}), ''), (c, at) -> if(at % 2 = 1,"
            f" int(substr('0246813579', cast(c as int) + 1, 1)), cast(c as int))), 0, (t, x) -> t + x)"
        )

    @staticmethod
    def mod97(text: str) -> str:
        """Remainder by 97 of letters and digits, letters standing for 10 to 35."""
        return (
            f"aggregate(split({text}, ''), 0L, (t, c) ->"
            f" if(c rlike '[0-9]', (t * 10 + cast(c as bigint)) % 97, (t * 100 + ascii(c) - 55) % 97))"
        )

    # Each kind: (condition on m, replacement of m). Conditions are only asked of what the kind's pattern matches.
    def email(self) -> tuple[str, str]:
        name = self.let("name", "substring_index(m, '@', 1)",
                        f"concat({self._by_class('name', 'lower(m)')}, substr(m, length(name) + 1))")
        return "true", name

    def secret(self) -> tuple[str, str]:
        head = "if(m like 'AKIA%', 4, 0)"
        return "true", f"concat(left(m, {head}), {self._by_class(f'substr(m, {head} + 1)', 'm')})"

    def _by_class(self, text: str, of: str) -> str:
        """Letters and digits of ``text`` replaced within their class by a keyed digest of the value ``of``.

        Hexadecimal text stays hexadecimal. The digest is taken anew for every 32 places.
        """
        byte = (
            f"cast(conv(substr(sha2(concat_ws('|', '{self.key}', 'text', cast(at div 32 as int), {of}), 256), 1 + 2 * (at % 32), 2), 16, 10) as int)"
        )
        pick = lambda letters: f"substr('{letters}', 1 + {byte} % {len(letters)}, 1)"
        lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return (
            f"array_join(transform(split({text}, ''), (c, at) -> case when c rlike '[0-9]' then {pick('0123456789')}"
            f" when c rlike '[a-f]' and {text} rlike '^[0-9a-f]+$' then {pick('abcdef')}"
            f" when c rlike '[a-z]' then {pick(lower)} when c rlike '[A-Z]' then {pick(upper)} else c end), '')"
        )

    def card(self) -> tuple[str, str]:
        digits = "regexp_replace(m, r'[^0-9]', '')"
        body = f"concat(left(d, 1), {self.digits('card', 'substr(d, 2, length(d) - 2)')})"
        whole = self.let("p", body, f"concat(p, cast((10 - {self.luhn("concat(p, '0')")} % 10) % 10 as string))")
        valid = f"length({digits}) between 13 and 19 and {self.luhn(digits)} % 10 = 0"
        return valid, self.let("d", digits, self.let("n", whole, self.refill("m", "[0-9]", "n")))

    def iban(self) -> tuple[str, str]:
        plain = "replace(m, ' ', '')"
        valid = f"length({plain}) between 15 and 34 and {self.mod97(f'concat(substr({plain}, 5), left({plain}, 4))')} = 1"
        own = self.let("d", "regexp_replace(substr(n, 5), r'[^0-9]', '')",
                       f"if(d = '', substr(n, 5), {self.let('q', self.digits('iban', 'd'), self.refill('substr(n, 5)', '[0-9]', 'q'))})")
        check = f"lpad(cast(98 - {self.mod97("concat(p, left(n, 2), '00')")} as string), 2, '0')"
        made = self.let("p", own, f"concat(left(n, 2), {check}, p)")
        # Blanks go back to where they were: every letter or digit takes the next one of the new value.
        spaced = (
            "array_join(transform(split(m, ''), (c, at) -> if(c = ' ', ' ', substr(w, length(replace(left(m, at + 1), ' ', '')), 1))), '')"
        )
        return valid, self.let("n", plain, self.let("w", made, spaced))

    def ssn(self) -> tuple[str, str]:
        area = "cast(left(m, 3) as int)"
        valid = f"{area} between 1 and 899 and {area} <> 666 and substr(m, 5, 2) <> '00' and right(m, 4) <> '0000'"
        # 898 areas without 666; 99 groups; 9999 serials.
        then = (
            "concat(lpad(cast(s.a + if(s.a >= 665, 2, 1) as string), 3, '0'), '-', lpad(cast(s.b div 9999 + 1 as string), 2, '0'),"
            " '-', lpad(cast(s.b % 9999 + 1 as string), 4, '0'))"
        )
        rest = "(cast(substr(m, 5, 2) as bigint) - 1) * 9999 + cast(right(m, 4) as bigint) - 1"
        return valid, self.feistel("ssn", f"{area} - if({area} > 666, 2, 1)", rest, "898", "989901", then)

    def phone(self) -> tuple[str, str]:
        digits = "regexp_replace(m, r'[^0-9]', '')"
        code = "length(regexp_extract(m, r'^.([0-9]{1,3})', 1))"
        # Without a separator after it, the country code is taken to be one digit for +1 and two otherwise.
        code = f"if(m rlike r'^.[0-9]{{4}}', if(m like '+1%', 1, 2), {code})"
        valid = f"length({digits}) between 8 and 15 and length({digits}) - {code} between 7 and 12"
        plan = f"m like '+1%' and {code} = 1 and {digits} rlike '^1[2-9][0-9]{{2}}[2-9][0-9]{{6}}$'"
        american = self.feistel(
            "nanp", "cast(substr(d, 2, 3) as bigint) - 200", "(cast(substr(d, 5, 3) as bigint) - 200) * 10000 + cast(right(d, 4) as bigint)",
            "800", "8000000",
            "concat('1', cast(s.a + 200 as string), cast(s.b div 10000 + 200 as string), lpad(cast(s.b % 10000 as string), 4, '0'))",
        )
        other = f"concat(left(d, {code}), {self.digits('phone', f'substr(d, {code} + 1)')})"
        made = self.let("n", f"if({plan}, {american}, {other})", self.refill("m", "[0-9]", "n"))
        return valid, self.let("d", digits, made)

    def ip(self) -> tuple[str, str]:
        part = lambda i: f"cast(split(m, '[.]')[{i}] as int)"
        valid = " and ".join(f"{part(i)} <= 255" for i in range(4))
        then = "concat_ws('.', s.a div 256, s.a % 256, s.b div 256, s.b % 256)"
        return valid, self.feistel("ip", f"{part(0)} * 256 + {part(1)}", f"{part(2)} * 256 + {part(3)}", "65536", "65536", then)

    def date(self) -> tuple[str, str]:
        iso = "m rlike '^[0-9]{4}-'"
        piece = lambda i: f"cast(split(m, '[-./]')[{i}] as int)"
        year = f"if({iso}, {piece(0)}, {piece(2)})"
        # With slashes the month comes first where only that gives a date; otherwise the day does.
        swapped = f"(m like '%/%' and {piece(0)} <= 12 and {piece(1)} > 12)"
        month = f"if({iso} or not {swapped}, {piece(1)}, {piece(0)})"
        day = f"if({iso}, {piece(2)}, if({swapped}, {piece(1)}, {piece(0)}))"
        leap = f"({year} % 4 = 0 and ({year} % 100 <> 0 or {year} % 400 = 0))"
        last = f"case when {month} in (4, 6, 9, 11) then 30 when {month} = 2 then if({leap}, 29, 28) else 31 end"
        valid = f"{year} between 1000 and 9999 and {month} between 1 and 12 and {day} between 1 and {last}"
        # A century has 36525 days (75 x 487) if its first year is a leap year, else 36524 (92 x 397).
        long = "(y div 100) % 4 = 0"
        size_a, size_b = f"if({long}, 75, 92)", f"if({long}, 487, 397)"
        first = "make_date(cast(y div 100 as int) * 100, 1, 1)"
        number = f"datediff(make_date(y, {month}, {day}), {first})"
        then = f"date_add({first}, cast(s.a * {size_b} + s.b as int))"
        moved = self.feistel("date", f"{number} div {size_b}", f"{number} % {size_b}", size_a, size_b, then)
        narrow = "not m rlike '^[0-9]{2}[./][0-9]{2}[./]'"
        shown = (
            f"case when {iso} then date_format(t, 'yyyy-MM-dd')"
            f" when {swapped} then date_format(t, if({narrow}, 'M/d/yyyy', 'MM/dd/yyyy'))"
            f" when m like '%/%' then date_format(t, if({narrow}, 'd/M/yyyy', 'dd/MM/yyyy'))"
            f" else date_format(t, if({narrow}, 'd.M.yyyy', 'dd.MM.yyyy')) end"
        )
        return valid, self.let("y", year, self.let("t", moved, shown))

    def parts(self) -> str:
        """A match ``m``, which a secret fills ``secret`` with, cut into values and what lies between: ``m`` and ``kind`` ('none')."""
        one = lambda kind: f"array(named_struct('m', m, 'kind', '{kind}'))"
        cases = [f"when secret <> '' then {one('secret')}"]
        for k, s in SHAPES.items():
            if k != "card":
                cases.append(f"when m rlike {_sql('^(?:' + s + ')$')} and {getattr(self, k)()[0]} then {one(k)}")
        # A word of capitals after an IBAN of an unlisted country, or digits behind what only looks like one.
        tail = "regexp_extract(m, r'^(.*) [A-Z0-9]+$', 1)"
        head = self.let("m", tail, f"if(m <> '' and {self.iban()[0]}, m, '')")
        shorter = self.let("h", head, f"if(h = '', {self.cards()}, array(named_struct('m', h, 'kind', 'iban'), named_struct('m', substr(m, length(h) + 1), 'kind', 'none')))")
        cases.append(f"when m rlike {_sql('^(?:' + SHAPES['iban'] + ')$')} then {shorter}")
        cases.append(f"when m rlike {_sql('^(?:' + SHAPES['card'] + ')$')} then {self.cards()}")
        return f"case {' '.join(cases)} else {one('none')} end"

    def cards(self) -> str:
        """Card numbers in the groups of ``m``: all of it, or runs of groups, those of 16, 15 and 19 digits first."""
        digits = "array_join(slice(g, i, j - i + 1), '')"
        # Groups i to j; all but the last of a shorter run have three digits or more.
        fits = (
            f"((i = 1 and j = size(g)) or forall(slice(g, i, j - i), x -> length(x) >= 3)) and {digits} rlike '^[0-9]{{13,19}}$'"
            f" and {self.luhn(digits)} % 10 = 0"
        )
        rank = f"if(i = 1 and j = size(g), 0, array_position(array(16, 15, 19, 14, 13, 18, 17), length({digits})))"
        best = (
            f"transform(sequence(1, size(g)), i -> array_min(transform(filter(sequence(i, least(i + 18, size(g))), j -> {fits}),"
            f" j -> named_struct('rank', {rank}, 'j', j))))"
        )
        # From left to right, unless a better run starts inside.
        taken = (
            "aggregate(sequence(1, size(g)), named_struct('next', 1, 'w', cast(array() as array<struct<i: int, j: int>>)),"
            " (s, i) -> if(i >= s.next and b[i - 1] is not null and not exists(slice(b, i + 1, greatest(b[i - 1].j - i, 0)), x -> coalesce(x.rank < b[i - 1].rank, false)),"
            " named_struct('next', b[i - 1].j + 1, 'w', array_append(s.w, named_struct('i', i, 'j', b[i - 1].j))), s), s -> s.w)"
        )
        # Places in m: a group starts after those before it and a separator for each.
        start = lambda k: f"length(array_join(slice(g, 1, {k} - 1), ' ')) + if({k} > 1, 2, 1)"
        stop = "length(array_join(slice(g, 1, x.j), ' ')) + 1"
        placed = f"transform({taken}, x -> named_struct('a', {start('x.i')}, 'b', {stop}))"
        pieces = (
            "flatten(transform(p, (x, k) -> array("
            "named_struct('m', substr(m, if(k = 0, 1, p[k - 1].b), x.a - if(k = 0, 1, p[k - 1].b)), 'kind', 'none'),"
            " named_struct('m', substr(m, x.a, x.b - x.a), 'kind', 'card'))))"
        )
        rest = "array(named_struct('m', substr(m, if(size(p) = 0, 1, p[size(p) - 1].b)), 'kind', 'none'))"
        return self.let("g", "split(m, '[ -]', -1)", self.let("b", best, self.let("p", placed, f"concat({pieces}, {rest})")))

    def replaced(self) -> str:
        """The pseudonym of a match ``x.m`` of kind ``x.kind``."""
        cases = [f"when x.kind = '{k}' then {self.let('m', 'x.m', getattr(self, k)()[1])}" for k in KINDS]
        return f"case {' '.join(cases)} else x.m end"


def pseudonymise(df: DataFrame, key: str, text: str = "text", found: str = "found", rounds: int = ROUNDS) -> DataFrame:
    """``df`` with ``text`` pseudonymised and ``found``, the replaced kinds in order of their places.

    A column named ``found`` in ``df`` is replaced; all others stay.
    """
    maker = Pseudonyms(key, rounds)
    pattern = _sql(_pattern())
    # Most texts have neither digits nor "@"; only the others are searched. A dummy keeps both arrays aligned.
    column = f"`{text}`"
    maybe = f"{column} rlike '[0-9@]|token|password|secret|api_key|AKIA'"
    matches = F.expr(
        f"if({maybe}, zip_with(regexp_extract_all({column}, {pattern}, 0), regexp_extract_all({column}, {pattern}, 1),"
        f" (m, secret) -> {maker.parts()}), array())"
    )
    pieces = F.expr(f"if({maybe}, split({column}, {pattern}, -1), array({column}))")
    staged = df.withColumn("__matches", matches).withColumn("__pieces", pieces)
    joined = F.expr(
        "concat(__pieces[0], array_join(transform(__matches, (y, k) -> concat(array_join(transform(y, x -> "
        + maker.replaced() + "), ''), __pieces[k + 1])), ''))"
    )
    hit = F.expr("size(__matches) > 0")
    kinds = F.expr("filter(transform(flatten(__matches), x -> x.kind), k -> k <> 'none')")
    return (
        staged.withColumn(text, F.when(hit, joined).otherwise(F.col(text)))
        .withColumn(found, F.coalesce(kinds, F.array().cast("array<string>")))
        .drop("__matches", "__pieces")
    )


def counts_by_kind(found: Column, kinds: Sequence[str] = KINDS) -> list[Column]:
    return [(F.size(found) - F.size(F.array_remove(found, k))).cast("long").alias(f"n_{k}") for k in kinds]
