"""Advanced regular expressions of a PostgreSQL database, as patterns for Java.

The two dialects agree on most signs and differ where it is easy to overlook: word boundaries,
character classes, what a dot and the anchors match, braces, and a few escapes. What Java has
no form for ends with a ``ValueError`` when the report is built, not with a failed task.
"""

from __future__ import annotations

from dataclasses import dataclass

# Character classes, and escapes with the same meaning in any place.
CLASSES = {
    "alpha": r"\p{IsAlphabetic}", "digit": r"\p{Nd}", "alnum": r"\p{IsAlphabetic}\p{Nd}",
    "upper": r"\p{IsUppercase}", "lower": r"\p{IsLowercase}", "space": r"\s\x0B\x85\p{Z}",
    "blank": r" \t", "punct": r"\p{Punct}", "cntrl": r"\p{Cntrl}", "xdigit": "0-9A-Fa-f",
    "graph": r"\p{Graph}", "print": r"\p{Print}", "word": r"\p{IsAlphabetic}\p{Nd}_",
}
SHORTHANDS = {"d": "digit", "s": "space", "w": "word"}
CHARACTERS = {"a": 0x07, "b": 0x08, "e": 0x1B, "f": 0x0C, "n": 0x0A, "r": 0x0D, "t": 0x09, "v": 0x0B}
WORD = f"[{CLASSES['word']}]"
CONSTRAINTS = {
    "A": r"\A", "Z": r"\z", "m": f"(?<!{WORD})(?={WORD})", "M": f"(?<={WORD})(?!{WORD})",
    "y": f"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))",
    "Y": f"(?:(?<!{WORD})(?!{WORD})|(?<={WORD})(?={WORD}))",
}
BOUNDS = {"[[:<:]]": "m", "[[:>:]]": "M"}
GROUPS = ("?:", "?=", "?!", "?<=", "?<!")
SPECIAL = set(r"\^$.|?*+()[]{}&-~#")


def quoted(sign: str) -> str:
    return "\\" + sign if sign in SPECIAL else sign


def hexadecimal(point: int) -> str:
    if point > 0x10FFFF:
        raise ValueError(f"no character has the number {point:#x}")
    return f"\\x{{{point:x}}}"


@dataclass
class Translator:
    """One pass over a pattern; ``at`` is the next sign to read."""

    pattern: str
    at: int = 0
    ignore_case: bool = True
    dot_matches_newline: bool = True
    anchors_at_newlines: bool = False
    expanded: bool = False

    def error(self, reason: str) -> ValueError:
        return ValueError(f"pattern {self.pattern!r}: {reason}")

    def ahead(self, text: str) -> bool:
        return self.pattern.startswith(text, self.at)

    def take(self, count: int = 1) -> str:
        if self.at + count > len(self.pattern):
            raise self.error("it ends too early")
        self.at += count
        return self.pattern[self.at - count : self.at]

    def translate(self) -> str:
        if self.ahead("***="):
            body = "".join(map(quoted, self.pattern[4:]))
        else:
            if self.ahead("***:"):
                self.at = 4
            elif self.ahead("***"):
                raise self.error("an unknown director follows the stars")
            literal = self.options()
            rest = self.pattern[self.at :]
            body = "".join(map(quoted, rest)) if literal else self.alternatives(0)
        flags = "iu" * self.ignore_case
        return (f"(?{flags})" if flags else "") + body

    def options(self) -> bool:
        """Read ``(?letters)`` at the start; whether the rest is to be taken literally."""
        end = self.pattern.find(")", self.at)
        letters = self.pattern[self.at + 2 : end] if self.ahead("(?") and end > 0 else ""
        if not letters or not letters.isalpha():
            return False
        self.at = end + 1
        literal = False
        for letter in letters:
            if letter in "ic":
                self.ignore_case = letter == "i"
            elif letter in "mnspw":
                self.dot_matches_newline = letter in "sw"
                self.anchors_at_newlines = letter in "mnw"
            elif letter in "xt":
                self.expanded = letter == "x"
            elif letter == "q":
                literal = True
            else:
                raise self.error(f"the option {letter} is not supported")
        return literal

    def alternatives(self, depth: int) -> str:
        out = []
        quantifiable = False
        while self.at < len(self.pattern):
            if self.expanded and self.skip():
                continue
            if self.ahead(")"):
                if not depth:
                    raise self.error("a closing parenthesis has no opening one")
                break
            if self.pattern[self.at] in "*+?" or self.bound():
                if not quantifiable:
                    raise self.error("a quantifier has nothing to repeat")
                out.append(self.quantifier())
                quantifiable = False
                continue
            piece, quantifiable = self.atom(depth)
            out.append(piece)
        return "".join(out)

    def skip(self) -> bool:
        """Pass over white space or a comment of an expanded pattern."""
        if self.pattern[self.at].isspace():
            self.at += 1
            return True
        if self.ahead("#"):
            end = self.pattern.find("\n", self.at)
            self.at = len(self.pattern) if end < 0 else end
            return True
        return False

    def bound(self) -> bool:
        """Whether a brace here opens a bound; one that no digit follows is a plain sign."""
        return self.ahead("{") and self.pattern[self.at + 1 : self.at + 2].isdigit()

    def quantifier(self) -> str:
        found = self.take()
        if found == "{":
            end = self.pattern.find("}", self.at)
            limits = self.pattern[self.at : end].split(",") if end >= 0 else []
            if len(limits) not in (1, 2) or not all(x.isdecimal() for x in limits if x or x is limits[0]):
                raise self.error("a bound must look like {m}, {m,} or {m,n}")
            numbers = [int(x) for x in limits if x]
            if max(numbers) > 255 or numbers != sorted(numbers):
                raise self.error("a bound is out of range")
            self.at = end + 1
            found = "{" + ",".join(limits) + "}"
        if self.ahead("?"):
            found += self.take()
        if self.at < len(self.pattern) and (self.pattern[self.at] in "*+?" or self.bound()):
            raise self.error("a quantifier follows another")
        return found

    def atom(self, depth: int) -> tuple[str, bool]:
        """The next part as Java reads it, and whether it can be repeated."""
        for text, name in BOUNDS.items():
            if self.ahead(text):
                self.take(len(text))
                return CONSTRAINTS[name], False
        sign = self.take()
        if sign == "(":
            opening = next((g for g in GROUPS if self.ahead(g)), "")
            if not opening and self.ahead("?"):
                raise self.error("this kind of group is not supported")
            self.take(len(opening))
            inner = self.alternatives(depth + 1)
            if not self.ahead(")"):
                raise self.error("a parenthesis is not closed")
            self.take()
            return f"({opening}{inner})", opening in ("", "?:")
        if sign == "[":
            return self.bracket(), True
        if sign == "\\":
            return self.escape()
        if sign == ".":
            return (r"[\s\S]" if self.dot_matches_newline else r"[^\n]"), True
        if sign == "^":
            return (r"(?:\A|(?<=\n))" if self.anchors_at_newlines else r"\A"), False
        if sign == "$":
            return (r"(?:\z|(?=\n))" if self.anchors_at_newlines else r"\z"), False
        if sign == "|":
            return sign, False
        return quoted(sign), True

    def escape(self) -> tuple[str, bool]:
        sign = self.take()
        if sign in CONSTRAINTS:
            return CONSTRAINTS[sign], False
        if sign.lower() in SHORTHANDS:
            inverse = "^" if sign.isupper() else ""
            return f"[{inverse}{CLASSES[SHORTHANDS[sign.lower()]]}]", True
        if sign in "123456789":
            if self.at < len(self.pattern) and self.pattern[self.at].isdigit():
                raise self.error("references beyond the ninth group are not supported")
            return f"(?:\\{sign})", True
        return self.character(sign), True

    def character(self, sign: str) -> str:
        """A sign after a backslash that stands for one character, in brackets or outside."""
        if sign in CHARACTERS:
            return hexadecimal(CHARACTERS[sign])
        if sign == "B":
            return r"\\"
        if sign == "c":
            return hexadecimal(ord(self.take()) & 0x1F)
        if sign in "uU":
            return hexadecimal(self.number(4 if sign == "u" else 8))
        if sign == "x":
            return hexadecimal(self.number(None))
        if sign == "0":
            digits = ""
            while len(digits) < 2 and self.at < len(self.pattern) and self.pattern[self.at] in "01234567":
                digits += self.take()
            return hexadecimal(int(digits or "0", 8))
        if sign.isalnum():
            raise self.error(f"the escape \\{sign} is not supported")
        return quoted(sign)

    def number(self, count: int | None) -> int:
        end = self.at
        while end < len(self.pattern) and self.pattern[end] in "0123456789abcdefABCDEF" and (
            count is None or end < self.at + count
        ):
            end += 1
        digits = self.pattern[self.at : end]
        if not digits or count not in (None, len(digits)):
            raise self.error("a character's number lacks digits")
        self.at = end
        return int(digits, 16)

    def bracket(self) -> str:
        """A bracket expression, its opening sign read: sets, ranges and named classes."""
        inverse = self.ahead("^")
        self.at += inverse
        parts = []
        first = True
        while first or not self.ahead("]"):
            first = False
            piece, single = self.member()
            if self.ahead("-") and self.pattern[self.at + 1 : self.at + 2] not in ("]", ""):
                self.take()
                last, also_single = self.member()
                if not single or not also_single:
                    raise self.error("a range needs a character at both ends")
                piece = f"{piece}-{last}"
            parts.append(piece)
        self.take()
        newline = r"\n" if inverse and not self.dot_matches_newline else ""
        return f"[{'^' * inverse}{''.join(parts)}{newline}]"

    def member(self) -> tuple[str, bool]:
        """A part of a bracket expression, and whether it is a single character."""
        sign = self.take()
        if sign == "[" and self.at < len(self.pattern) and self.pattern[self.at] in ":.=":
            kind = self.take()
            end = self.pattern.find(kind + "]", self.at)
            if end < 0:
                raise self.error("a class in brackets is not closed")
            name = self.pattern[self.at : end]
            self.at = end + 2
            if kind == ":":
                if name not in CLASSES:
                    raise self.error(f"there is no character class {name}")
                return CLASSES[name], False
            if len(name) != 1:
                raise self.error("collating elements of several characters are not supported")
            return quoted(name), kind == "."
        if sign == "\\":
            escaped = self.take()
            if escaped in SHORTHANDS:
                return CLASSES[SHORTHANDS[escaped]], False
            return self.character(escaped), True
        return quoted(sign), True


def java_pattern(pattern: str) -> str:
    """The pattern for Java, case-insensitive unless it begins with ``(?c)``."""
    return Translator(pattern).translate()
