"""Sentence boundaries across languages and scripts, in SQL expressions only.

Every step replaces single characters by single private-use placeholders, so the masked text keeps the length of the
original and offsets in it are offsets in the text:

1. end marks, quotes and brackets of all scripts become neighbouring placeholders (one range is tested far faster than a
   list of characters), and blank lines and list items are marked;
2. end marks inside addresses, dots of decimals, file names, initials, abbreviations, ordinals and list marks are masked;
3. ellipses are masked where they end nothing;
4. end marks inside quotations and brackets are masked, and the closing mark remembers whether one stood before it;
5. the masked text is split by the terminators of all scripts, blank lines, list items and, between Thai letters, blanks;
6. the units' text is restored by their offsets.

Definition of the cases: null gives no unit, nor does a text of blanks. Texts that already hold characters of the
placeholder range are split as if these were ordinary letters.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# End marks, quotation and bracket pairs, abbreviations.
TERMINATORS = ".!?…。！？।॥؟۔．｡‼⁇⁈⁉"
QUOTES = [("“", "”“"), ("„", "“”"), ("«", "»"), ("「", "」"), ("『", "』"), ("‹", "›"), ("‘", "’"), ('"', '"')]
BRACKETS = [("(", ")"), ("（", "）"), ("[", "]"), ("【", "】")]
#: Never at the end of a sentence, whatever follows.
NEVER_FINAL = (
    "Mr Mrs Ms Dr Dra Drs Prof Capt Col Gen Lt Sgt Rev Hon St Ste Sr Sra Srta Fig Figs fig figs Eq eq Vol vol Vols Ch ch Sec sec "
    "Nos nos pp cf Cf vs approx Approx ca Ca bzw vgl Vgl Abb Tab Nr nr Mio Mrd evtl ggf sog inkl zzgl Hr Fr Frl Str "
    "Mme Mlle Mgr MM env Env ex núm Núm pág Pág págs aprox Aprox ej EE Ud Uds Avda tel Tel "
    "рис Рис ул просп пер см См стр Стр Проф проф Акад акад им пос ок руб табл "
    "डॉ प्रो श्री श्रीमती सं पृ"
).split()
#: At the end only if a new sentence follows.
MAYBE_FINAL = "etc usw Ltd Inc Co Corp Bros Jr UU Mon Tues Tue Wed Thurs Thu Fri Sat Sun Jan Feb Mar Apr Aug Sept Sep Oct Nov Dec пикс тыс млн млрд др пр".split()
#: Letter pairs that never end a sentence.
NEVER_FINAL_PAIRS = ["e.g", "i.e", "z.B", "d.h", "u.a", "o.ä", "s.o", "p.ex", "т.е", "т.ч"]
ORDINAL_AFTER = "Im im Am am Vom vom Zum zum Beim beim Der der Die die Das das Dem dem Den den Des des Ab ab Bis bis Seit seit".split()
FILE_ENDINGS = "json jsonl jpeg jpg png gif bmp webp tif tiff txt csv tsv md html htm xml yaml yml py pdf zip gz parquet npy".split()
DOMAINS = "com org net edu gov io dev info".split()

_BASE = 0xE000
#: Quotes and brackets beyond Latin-1, the East Asian ones in the middle; then the end marks beyond Latin-1.
_OPEN, _CLOSE = "“„‹‘「『（【：", "」』）】”›’"
_EAST = "「『（【：」』）】"
_END_EAST = "。！？．｡"
_code = {c: chr(_BASE + 0x40 + k) for k, c in enumerate(_OPEN + _CLOSE)}
_closers = sorted({c for _, cs in QUOTES for c in cs} | {"'"} | {c for _, c in BRACKETS})
_shut = {c: chr(_BASE + k) for k, c in enumerate(_closers)}  # closes, no end mark before it
_ended = {c: chr(_BASE + 0x10 + k) for k, c in enumerate(_closers)}  # closes after an end mark
MASK = chr(_BASE + 0x20)  # an end mark that ends nothing
_final = {c: chr(_BASE + 0x21 + k) for k, c in enumerate(_closers)}  # closes and ends the sentence
END, END_EAST = chr(_BASE + 0x31), chr(_BASE + 0x32)
PARAGRAPH, ITEM, THAI = chr(_BASE + 0x33), chr(_BASE + 0x34), chr(_BASE + 0x35)
DOT, APOSTROPHE, OPEN_STRAIGHT, OPEN_SINGLE = (chr(_BASE + 0x38 + k) for k in range(4))  # DOT: a dot that ends nothing
LINE, STOP = chr(_BASE + 0x3C), chr(_BASE + 0x3D)  # a line break or dot put aside during a step; turned back before the next
_plain = _code | {c: END_EAST if c in _END_EAST else END for c in TERMINATORS if c not in ".!?…"}

# Characters of classes: neighbours among the placeholders.
_CLOSERS = f"{chr(_BASE)}-{chr(_BASE + 0x1F)}"
_MARKS = f".!?…{chr(_BASE + 0x10)}-{END_EAST}"
_ENDS = f".!?{chr(_BASE + 0x21)}-{END_EAST}"
_STARTS = f".!?{chr(_BASE + 0x21)}-{ITEM}"
_STOPS = f".!?{chr(_BASE + 0x21)}-{THAI}"

_BLANKS = " \t\n\x0b\f\r\x85\x1c\x1d\x1e\x1f\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_BLANK = r"\s\p{Z}\x{85}\x{1c}-\x{1f}"
_WORD = r"\p{L}\p{N}\p{M}_"
_CJK = rf"\x{{3000}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}\x{{ff00}}-\x{{ffef}}{END_EAST}{_code['「']}-{_code['】']}"
_THAI = r"\x{e00}-\x{e4f}\x{e5a}-\x{e7f}"
_SMALL = rf"(?!\p{{L}}*[_\d])\p{{Ll}}"  # a small first letter that is not an identifier's


def _any(words: list[str]) -> str:
    return "|".join(sorted((w.replace(".", r"\.") for w in words), key=len, reverse=True))


def _replace(c: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, to in pairs:
        c = F.regexp_replace(c, F.lit(pattern), F.lit(to))
    return c


def _translate(c: Column, mapping: dict[str, str]) -> Column:
    return F.translate(c, "".join(mapping), "".join(mapping.values()))


def _segments(c: Column, special: str, between: str, is_special: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``change`` applied to each part of ``c`` that matches ``special``; ``between`` matches what lies between them."""
    parts = F.regexp_extract_all(c, F.lit(f"{special}|{between}|[\\s\\S]"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(is_special(p), change(p)).otherwise(p)), "")


def _from_openers(c: Column, special: str, openers: str, change: Callable[[Column], Column]) -> Column:
    """As ``_segments``, where all special parts begin with one of ``openers``."""
    shown = "".join("\\" + o if o in "[]" else o for o in openers)
    return _segments(c, special, f"[^{shown}]+", lambda p: (F.length(p) > 1) & F.substring(p, 1, 1).isin(*openers), change)


def _enclosed(opening: dict[str, str]) -> Callable[[Column], Column]:
    """Masks the end marks of an enclosed part; its closing mark tells whether an end mark stood before it, and whether
    the part was introduced by a colon and so ends its sentence."""
    told = lambda state: {_code.get(k, k): v for k, v in state.items()}
    inside = dict.fromkeys([".", "!", "?", "…", END, END_EAST], MASK) | opening | {v: _ended[k] for k, v in _final.items()}

    def change(p: Column) -> Column:
        last = F.substring(p, -1, 1)
        ended = p.rlike(f"[{_MARKS}][{_BLANK}]*[\\s\\S]$")
        introduced = F.substring(p, 1, 1).isin(":", _code["："])
        closing = F.when(ended & introduced, _translate(last, told(_final))).when(ended, _translate(last, told(_ended))).otherwise(_translate(last, told(_shut)))
        return F.concat(_translate(p.substr(F.lit(1), F.length(p) - 1), inside), closing)

    return change


#: A pattern, or strings, without which a text does not need the change; and the change.
Step = tuple[str | tuple[str, ...], Callable[[Column], Column]]


def steps() -> list[Step]:
    """The masking steps in order.

    After all of them a text has its old length, and every end mark left in it ends a unit. What may be of any length before
    a mark is matched forwards and put back, so nothing hangs on how many blanks or letters stand there.
    """
    listed = rf"[ \t\x{{3000}}\x{{a0}}]*(?:[-*•‣▪◦·–—][ \t\x{{a0}}\x{{3000}}]|\(?\d{{1,3}}[.)][ \t\x{{a0}}\x{{3000}}]|\(?[a-zA-Z]\)[ \t\x{{a0}}])"
    unfinished = rf"([^{_WORD}](?:{_any([w + '.' for w in NEVER_FINAL + ['No', 'no', 'p', 'S', 's']] + ORDINAL_AFTER)})[ \t\r]*+)\n"
    alone = rf"(?<![{_WORD}])"
    follows = rf"(?=[{_BLANK}]*[,;:)\]]|[{_BLANK}]+{_SMALL})"
    going_on = rf"[{_BLANK}]*(?:[,;:]|{_SMALL})"
    in_dots = r"(?:(?<=\.\.)|(?=\.))"
    in_address = rf"(?=[^\s\p{{Z}}<>\"{_code['”']}»)\]]*[\p{{L}}\p{{N}}/#=])"
    address = r"(?:https?://|www\.)"
    dot = [
        # decimals, file names, addresses of mail
        r"(?=\d)(?<=\d\.)",
        rf"(?=\d)(?<![{_WORD}.!?…]\.)",
        rf"(?<=[{_WORD}]\.)(?=[a-z])(?=(?:{_any(FILE_ENDINGS + DOMAINS)})(?![A-Za-z0-9_]))",
        r"(?<=[\w-]\.)(?=[\w.-]+@)",
        # letters joined by dots; the last dot of such a chain; single letters
        rf"(?=\p{{L}}\.)(?<={alone}\p{{L}}\.)|(?=\p{{L}}\.)(?<=\p{{L}}\.\p{{L}}\.)",
        rf"(?<={alone}(?:{_any(NEVER_FINAL_PAIRS)})\.)",
        rf"(?<=\p{{L}}\.\p{{L}}\.){follows}",
        rf"(?<=(?<![{_WORD}.])\p{{L}}\p{{M}}{{0,3}}\.)",
        # abbreviations
        rf"(?<={alone}[Nn]o\.)(?=[{_BLANK}]*\d)",
        rf"(?<={alone}(?:{_any(NEVER_FINAL)})\.)",
        rf"{follows}(?<={alone}(?:{_any(MAYBE_FINAL)})\.)",
        # ellipses: never an end before Chinese and Japanese, elsewhere none if the sentence goes on
        rf"{in_dots}(?=\.*[{_CJK}])",
        rf"{in_dots}(?=\.*{going_on})",
        r"(?=[.!?]*[,;:])",
    ]
    inside_address = lambda p: _replace(p, *[(rf"{m}{in_address}", to) for m, to in ((r"\.", DOT), ("!", MASK), (r"\?", MASK))])
    coded = lambda chars: "".join(_code.get(c, c) for c in chars)
    doubles = [(coded(a), coded(z)) for a, z in QUOTES if a != "‘"]
    inside = {a: "".join(sorted(({a} if a != '"' else set()) | set(z))) for a, z in doubles}
    colons, colon = f":{_code['：']}", f"(?:[:{_code['：']}][{_BLANK}]*)?"
    left, right = coded("‘"), coded("’")
    quoted = colon + "(?:" + "|".join(f"{a}[^{inside[a]}{PARAGRAPH}]*[{z}]" for a, z in doubles) + ")"
    single = rf"'(?=[\p{{L}}¿¡])[^'{PARAGRAPH}]*'(?![\p{{L}}\p{{N}}])|{left}[^{left}{right}{PARAGRAPH}]*{right}(?![\p{{L}}\p{{N}}])"
    escaped = {c: "\\" + c if c in "()[]" else coded(c) for pair in BRACKETS for c in pair}
    enclosed = "|".join(f"{escaped[a]}[^{escaped[a]}{escaped[z]}{PARAGRAPH}]*{escaped[z]}" for a, z in BRACKETS)
    openers = {"quotes": "".join(a for a, _ in doubles), "brackets": "".join(coded(a) for a, _ in BRACKETS)}
    between = [
        # a bracket that stands between sentences with its end mark inside is a unit; so is one that follows such a one
        (rf"((?:(?:\A|[{_STARTS}][{_CLOSERS}]*+)[{_BLANK}]*+|\G(?!\A)[{_BLANK}]*+){escaped[a]}[^{_shut[z]}{_ended[z]}{_final[z]}{PARAGRAPH}]*){_ended[z]}", f"$1{_final[z]}")
        for a, z in BRACKETS[:2]
    ]
    return [
        (r"[^\x{0}-\x{ff}]", lambda c: _translate(_replace(c, (f"[{chr(_BASE)}-{chr(_BASE + 0xFF)}]", "�")), _plain)),
        (("\n",), lambda c: _replace(c, (r"\n(?=[ \t\r\f\x{a0}\x{3000}\x{200b}]*\n)", PARAGRAPH))),
        (rf"\n{listed}", lambda c: _translate(_replace(c, (unfinished, f"$1{LINE}"), (rf"\n(?={listed})", ITEM)), {LINE: "\n"})),
        (("http", "www."), lambda c: _segments(c, rf"{address}[^\s\p{{Z}}{PARAGRAPH}{ITEM}]*", rf"(?:(?!{address})[\s\S])+", lambda p: p.rlike(f"^{address}"), inside_address)),
        (r"\d\.[ \t\x{a0}\x{3000}]", lambda c: _replace(c, (rf"((?:^|[{PARAGRAPH}{ITEM}])[{_BLANK}]*+\(?\d{{1,3}})\.(?=[ \t\x{{a0}}\x{{3000}}])", f"$1{DOT}"))),
        (rf"[{_BLANK}]\d{{1,2}}\.[{_BLANK}]", lambda c: _replace(c, (rf"((?:^|[^{_WORD}])(?:{_any(ORDINAL_AFTER)})[{_BLANK}]+\d{{1,2}})\.(?=[{_BLANK}])", f"$1{DOT}"))),
        (("..", "…"), lambda c: _replace(c, (rf"(?<=[{_CJK}])\.(?=\.)|\G(?!\A)\.", DOT), (rf"(?<=[{_CJK}])…|\G(?!\A)…", MASK))),
        (("т.",), lambda c: _replace(c, (rf"({alone}т\.[{_BLANK}]+[дп])\.(?!\.){follows.replace('(?=', '(?!', 1)}", f"$1{STOP}"))),
        ((".",), lambda c: _replace(c, (rf"\.(?:{'|'.join(dot)})", DOT))),
        (r"[!?][.!?]*[,;:]", lambda c: _replace(c, (r"[!?](?=[.!?]*[,;:])", MASK))),
        (("…", STOP), lambda c: _translate(_replace(c, (rf"…(?:(?=…*[{_CJK}])|(?=…*{going_on}))", MASK)), {STOP: ".", "…": END})),
        (tuple(openers["quotes"]), lambda c: _from_openers(c, quoted, openers["quotes"] + colons, _enclosed({'"': OPEN_STRAIGHT}))),
        (("'",), lambda c: _replace(c, (r"'(?<=[\p{L}\p{N}]')(?=\p{L})", APOSTROPHE))),
        (("'", left), lambda c: _from_openers(c, f"{colon}(?:{single})", f"'{left}{colons}", _enclosed({"'": OPEN_SINGLE}))),
        (tuple(openers["brackets"]), lambda c: _from_openers(c, enclosed, openers["brackets"], _enclosed({}))),
        ((_ended[")"], _ended["）"]), lambda c: _replace(c, *between)),
        (rf"[{_THAI}] ", lambda c: _replace(c, (rf" (?<=[{_THAI}] )(?=[ \x{{a0}}]*[{_THAI}])", THAI))),
    ]


def masked(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the placeholders put into ``column``, one projection a step; texts that need no step pass it by."""
    for gate, change in steps():
        c = F.col(column)
        needed = c.rlike(gate) if isinstance(gate, str) else reduce(Column.__or__, [F.contains(c, F.lit(x)) for x in gate])
        df = df.withColumn(column, F.when(needed, change(c)).otherwise(c))
    return df


def units(masked: Column) -> Column:
    """The consecutive parts of a masked text, each with its end marks; together they are the whole text."""
    after = f"[{_ENDS}{_CLOSERS}{_code['」']}-{_code['’']}»\"')\\]]"
    return F.regexp_extract_all(masked, F.lit(f"[^{_STOPS}]*+(?:[{_ENDS}]{after}*+|[{PARAGRAPH}-{THAI}])|[^{_STOPS}]++"), F.lit(0))


BLOCK = 128


def running_starts(lengths: Column) -> Column:
    """For an array of lengths the sum of those before each, in blocks, so that long arrays are not copied over and over."""
    none = F.array().cast("array<int>")

    def before(values: Column) -> Column:
        first = F.struct(none.alias("at"), F.lit(0).alias("sum"))
        return F.aggregate(values, first, lambda a, n: F.struct(F.concat(a["at"], F.array(a["sum"])).alias("at"), (a["sum"] + n).alias("sum")), lambda a: a["at"])

    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    sums = before(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda a, n: a + n)))
    within = F.transform(F.arrays_zip(blocks.alias("x"), sums.alias("s")), lambda z: F.transform(before(z["x"]), lambda v: v + z["s"]))
    return F.when(F.size(lengths) <= BLOCK, before(lengths)).otherwise(F.flatten(within))


def split_sentences(df: DataFrame, key: str, text: str, restore: bool = False) -> DataFrame:
    """One row for each sentence unit of every text: key, place (from 0), start_at, end_at and, with ``restore``, sentence.

    Offsets count code points from 0; end_at is one past the unit's last character. Rows of ``df`` are taken as they
    are: two rows with equal key and text give their units twice.
    """
    blanks = F.lit(_BLANKS + PARAGRAPH + ITEM + THAI)
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    split = masked(rows.withColumn("_masked", F.col("_text")), "_masked").select("_key", "_text", units(F.col("_masked")).alias("_units"))
    parts = split.withColumn("_lengths", F.transform("_units", F.length))
    starts = running_starts(F.col("_lengths"))
    each = parts.select("_key", "_text", F.posexplode(F.arrays_zip(F.col("_units").alias("u"), starts.alias("s"))).alias("_pos", "_z"))
    unit, start = F.col("_z").getField("u"), F.col("_z").getField("s")
    left = F.ltrim(unit, blanks)
    found = each.select("_key", "_text", "_pos", (start + F.length(unit) - F.length(left)).alias("start_at"), F.rtrim(left, blanks).alias("_bare")).filter("_bare <> ''")
    end = (F.col("start_at") + F.length("_bare")).alias("end_at")
    columns = [F.col("_key").alias(key), F.col("_pos").alias("place"), "start_at", end]
    if restore:
        columns.append(F.col("_text").substr(F.col("start_at") + 1, F.length("_bare")).alias("sentence"))
    return found.select(*columns)
