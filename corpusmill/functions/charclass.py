"""Character classes shared by the Spark (Java regex) and DuckDB (RE2) forms of the cleaner.

Java's ``\\s``/``\\w`` and RE2's are not Python's, so every class is spelt out.
All members are written as ranges or ``\\x{..}`` escapes that both engines read the same way.
"""

# ---------------------------------------------------------------------------
# These must equal the reference cleaner's behaviour.
# ---------------------------------------------------------------------------
# Python ``str.isspace()``: \t \n \v \f \r, U+001C-U+001F, space, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000 (29 characters).
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# ASCII punctuation (Python ``string.punctuation``, 32 characters): ! to /, : to @, [ to `, { to ~.
P = r"!-/:-@\[-`{-~"
# Letters kept by the cleaner and counted by the word gate.
L = "A-Za-zŒœÀ-ÂÇ-ÊÏÔà-âç-êïôû"
# Python ``\w`` for str patterns: letters, numbers, underscore.
W = r"\p{L}\p{N}_"
# Line boundaries of ``str.splitlines()``: \r\n as one, or one of \n \r \v \f U+001C-U+001E U+0085 U+2028 U+2029.
LINE_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
# Punctuation followed by a space (T11) and preceded by one.
PUNCT_SPACE_AFTER = ":;,!?."
PUNCT_SPACE_BEFORE = ":;!?"
# Minimum words of the gate and long-word cut.
DEFAULT_MIN_WORDS = 3
LONG_WORD = 35
# ---------------------------------------------------------------------------

# The individual characters of WS and P, for the RE2 rewrite of "run of the same character".
WS_CHARS = [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                             *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
P_CHARS = [chr(c) for c in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F))]


def esc(ch: str) -> str:
    """Regex escape of one character usable by Java and RE2."""
    return "\\x{%x}" % ord(ch)


def _class_items(body: str) -> tuple[list[tuple[int, int]], list[str]]:
    """Parse the class bodies above (literals, ``a-b`` ranges, ``\\x{..}``, ``\\t``, ``\\r``, ``\\[``, ``\\p{..}``)."""
    simple = {"t": 0x09, "r": 0x0D, "n": 0x0A, "[": 0x5B, "]": 0x5D, "\\": 0x5C, "-": 0x2D}
    cps: list[int | str] = []
    i = 0
    while i < len(body):
        ch = body[i]
        if ch == "\\":
            nxt = body[i + 1]
            if nxt == "x":
                j = body.index("}", i)
                cps.append(int(body[i + 3 : j], 16))
                i = j + 1
            elif nxt == "p":
                j = body.index("}", i)
                cps.append(body[i : j + 1])
                i = j + 1
            else:
                cps.append(simple[nxt])
                i += 2
        elif ch == "-" and cps and isinstance(cps[-1], int) and i + 1 < len(body):
            cps.append("-")
            i += 1
        else:
            cps.append(ord(ch))
            i += 1
    ranges, props, k = [], [], 0
    while k < len(cps):
        item = cps[k]
        if isinstance(item, str) and item != "-":
            props.append(item)
            k += 1
        elif k + 2 < len(cps) and cps[k + 1] == "-" and isinstance(cps[k + 2], int):
            ranges.append((item, cps[k + 2]))
            k += 3
        else:
            ranges.append((item, item))
            k += 1
    return ranges, props


MAX_CP = 0x10FFFF


def _complement(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, nxt = [], 0
    for lo, hi in sorted(ranges):
        if lo > nxt:
            out.append((nxt, lo - 1))
        nxt = max(nxt, hi + 1)
    if nxt <= MAX_CP:
        out.append((nxt, MAX_CP))
    return out


def java_class(*bodies: str, negate: bool = False) -> str:
    """The same set as ``[`` + bodies + ``]`` (or ``[^`` ... ``]`` with ``negate``) laid out for Java's
    matcher, to be used inside a *positive* class: members below U+0100 as single characters (Java
    gathers those into one 256-entry bit table), the rest as ranges and properties. A negated set is
    written out as its explicit complement ranges, because Java matches a negated class that has
    members above U+00FF an order of magnitude slower. Membership is unchanged."""
    ranges: list[tuple[int, int]] = []
    props: list[str] = []
    for body in bodies:
        rs, ps = _class_items(body)
        ranges += rs
        props += ps
    if negate:
        if props:
            raise ValueError("cannot complement a class holding Unicode properties")
        ranges = _complement(ranges)
    singles: set[int] = set()
    wide: list[tuple[int, int]] = []
    for lo, hi in ranges:
        for cp in range(lo, min(hi, 0xFF) + 1):
            singles.add(cp)
        if hi > 0xFF:
            wide.append((max(lo, 0x100), hi))
    out = "".join("\\x{%x}" % cp for cp in sorted(singles))
    out += "".join("\\x{%x}" % lo if lo == hi else "\\x{%x}-\\x{%x}" % (lo, hi) for lo, hi in sorted(wide))
    return out + "".join(props)


def _latin1_word_chars() -> str:
    """Members of ``W`` below U+0100 (letters and numbers by Unicode category, plus underscore)."""
    import unicodedata

    cps = [cp for cp in range(0x100) if unicodedata.category(chr(cp))[0] in "LN" or cp == 0x5F]
    return "".join("\\x{%x}" % cp for cp in cps)


def java_narrow(*bodies: str, negate: bool = False) -> str:
    """The members below U+0100 (with ``negate``: those below U+0100 that are none), as single characters: a class of
    these alone is one bit table for Java, which a look-ahead can ask before a class with wider ranges."""
    cps = {cp for body in bodies for lo, hi in _class_items(body)[0] for cp in range(lo, min(hi, 0xFF) + 1)}
    return "".join("\\x{%x}" % cp for cp in range(0x100) if (cp in cps) != negate)


# Java layouts of the classes (same members, cheaper matching); the RE2 oracle uses the plain forms.
J_WS = java_class(WS)
J_P = java_class(P)
J_L = java_class(L)
J_W = java_class(_latin1_word_chars(), W)
J_NOT_WS = java_class(WS, negate=True)
J_NOT_KEEP = java_class(L, "0-9", P, WS, negate=True)
J_P_WS = java_class(P, WS)
J_KEEP_NARROW = java_narrow(L, "0-9", P, WS)
J_NOT_P_WS_NARROW = java_narrow(P, WS, negate=True)
# Every word character and more: anything but ASCII's other characters.
J_MAYBE_W = "^" + java_narrow(r"\x{00}-/:-@\[-^`{-\x{7f}")
