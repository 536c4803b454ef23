"""Python regular expressions as Java patterns, made when a plan is made.

A pattern that Python rejects is skipped, as the mapped ingest does. One that
Python accepts is read by Python's own pattern reader (so verbose mode, octal
numbers, class syntax and flags mean what they mean there), and written again in
plain Java syntax, with nothing left to Java's different meanings:

* white space, word characters and word boundaries are Python's, as classes;
* ``.`` stops at a line feed only; ``^``, ``$``, ``\\Z`` are written as what they
  stand for;
* ``[`` and ``&&`` inside a class are plain characters;
* flags for a part of a pattern hold for that part.

A conditional (``(?(1)a|b)``) has no Java form; making the plan fails with a
clear error. None is dropped silently.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as P

from pyspark import SparkContext

from .text import PY_WHITESPACE

#: Classes as Java writes them, without brackets.
WORD = r"\p{L}\p{N}_"
SPACE = "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE)
_UNICODE = {C.CATEGORY_DIGIT: r"\p{Nd}", C.CATEGORY_SPACE: SPACE, C.CATEGORY_WORD: WORD}
_ASCII = {C.CATEGORY_DIGIT: "0-9", C.CATEGORY_SPACE: r"\x{9}-\x{d}\x{20}", C.CATEGORY_WORD: "a-zA-Z0-9_"}
_OPPOSITE = {C.CATEGORY_NOT_DIGIT: C.CATEGORY_DIGIT, C.CATEGORY_NOT_SPACE: C.CATEGORY_SPACE, C.CATEGORY_NOT_WORD: C.CATEGORY_WORD}
_SINGLE = (C.LITERAL, C.NOT_LITERAL, C.ANY)


def _char(code: int) -> str:
    c = chr(code)
    return c if c.isascii() and c.isalnum() else f"\\x{{{code:x}}}"


def _categories(flags: int) -> dict:
    return _ASCII if flags & re.ASCII else _UNICODE


def _class(items: list, flags: int) -> str:
    """One character of a class. Opposites such as ``\\W`` beside other members
    become an alternation, or look-aheads where the class is negated."""
    known, inside, opposites, negated = _categories(flags), "", [], False
    for op, av in items:
        if op is C.NEGATE:
            negated = True
        elif op is C.LITERAL:
            inside += _char(av)
        elif op is C.RANGE:
            inside += f"{_char(av[0])}-{_char(av[1])}"
        elif av in _OPPOSITE:
            opposites.append(known[_OPPOSITE[av]])
        else:
            inside += known[av]
    if not negated:
        parts = ([f"[{inside}]"] if inside else []) + [f"[^{o}]" for o in opposites]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
    if not opposites:
        return f"[^{inside}]"
    ahead = (f"(?![{inside}])" if inside else "") + "".join(f"(?=[{o}])" for o in opposites[:-1])
    return f"(?:{ahead}[{opposites[-1]}])"


def _is_word(item, flags: int) -> bool:
    if item is None or item[0] is not C.LITERAL:
        return False
    c = chr(item[1])
    return (c.isalnum() or c == "_") and (c.isascii() or not flags & re.ASCII)


def _place(where, before, after, flags: int) -> str:
    if where is C.AT_BEGINNING:
        return r"(?<![^\n])" if flags & re.MULTILINE else r"\A"
    if where is C.AT_END:
        return r"(?![^\n])" if flags & re.MULTILINE else r"(?=\n?\z)"
    if where in (C.AT_BEGINNING_STRING, C.AT_END_STRING):
        return r"\A" if where is C.AT_BEGINNING_STRING else r"\z"
    w = _categories(flags)[C.CATEGORY_WORD]
    if where is C.AT_BOUNDARY:
        if _is_word(after, flags):
            return f"(?<![{w}])"
        if _is_word(before, flags):
            return f"(?![{w}])"
        return f"(?:(?<=[{w}])(?![{w}])|(?<![{w}])(?=[{w}]))"
    return f"(?!\\A\\z)(?:(?<=[{w}])(?=[{w}])|(?<![{w}])(?![{w}]))"


def _times(low: int, high) -> str:
    if (low, high) == (0, 1):
        return "?"
    if high is C.MAXREPEAT:
        return {0: "*", 1: "+"}.get(low, f"{{{low},}}")
    return f"{{{low},{high}}}"


def _java(items, flags: int) -> str:
    items, out = list(items), []
    for i, (op, av) in enumerate(items):
        if op is C.LITERAL:
            out.append(_char(av))
        elif op is C.NOT_LITERAL:
            out.append(f"[^{_char(av)}]")
        elif op is C.ANY:
            out.append(r"(?s:.)" if flags & re.DOTALL else r"[^\n]")
        elif op is C.IN:
            out.append(_class(av, flags))
        elif op is C.AT:
            out.append(_place(av, items[i - 1] if i else None, items[i + 1] if i + 1 < len(items) else None, flags))
        elif op is C.BRANCH:
            out.append("(?:" + "|".join(_java(b, flags) for b in av[1]) + ")")
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, sub = av
            one = _java(sub, flags)
            plain = len(sub) == 1 and (sub[0][0] in _SINGLE or (sub[0][0] is C.IN and one.startswith("[")))
            out.append((one if plain else f"(?:{one})") + _times(low, high) + {C.MIN_REPEAT: "?", C.POSSESSIVE_REPEAT: "+"}.get(op, ""))
        elif op is C.SUBPATTERN:
            group, add, drop, sub = av
            own = (flags & ~(re.ASCII | re.UNICODE | re.LOCALE) if add & (re.ASCII | re.UNICODE) else flags) | add
            own &= ~drop
            body = _java(sub, own)
            if _case(own) != _case(flags):
                body = f"(?{_case(own) or '-iu'}:{body})"
            out.append(f"({body})" if group is not None else f"(?:{body})")
        elif op is C.ATOMIC_GROUP:
            out.append(f"(?>{_java(av, flags)})")
        elif op in (C.ASSERT, C.ASSERT_NOT):
            side, sub = av
            out.append(f"(?{'<' if side < 0 else ''}{'=' if op is C.ASSERT else '!'}{_java(sub, flags)})")
        elif op is C.GROUPREF:
            out.append(f"(?:\\{av})")
        elif op is C.FAILURE:
            out.append("(?!)")
        else:
            raise ValueError(f"{str(op).lower()} has no Java form")
    return "".join(out)


def _case(flags: int) -> str:
    return "" if not flags & re.IGNORECASE else "i-u" if flags & re.ASCII else "iu"


def java_parts(pattern: str) -> tuple[str, str] | None:
    """(leading flags, body) of the Java form; None if Python rejects the pattern."""
    try:
        re.compile(pattern)
        tree = P.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    flags = tree.state.flags
    try:
        return f"(?{_case(flags)})" if _case(flags) else "", _java(tree, flags)
    except ValueError as e:
        raise ValueError(f"pattern {pattern!r}: {e}") from None


def to_java(pattern: str) -> str | None:
    """The Java form of a Python pattern; None if Python rejects it."""
    parts = java_parts(pattern)
    return None if parts is None else "".join(parts)


#: Letters that no character beyond ASCII folds to, and shorter literals tell little.
_SOLID, SHORTEST = set("abcdefghjlmnopqrtuvwxyz0123456789") | set(" -_./&"), 3


def _needed(items) -> frozenset[str] | None:
    """Lower-case literals of which the lower-cased text of any match holds at
    least one; None where nothing can be said. The best of the sequence's parts."""
    found, run = [], ""

    def ended():
        if len(run) >= SHORTEST:
            found.append(frozenset([run]))
    for op, av in items:
        if op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
            continue                                   # no width: the letters around it are neighbours
        c = chr(av).lower() if op is C.LITERAL else ""
        if c in _SOLID:
            run += c
            continue
        ended()
        run, part = "", None
        if op is C.SUBPATTERN:
            part = _needed(av[3])
        elif op is C.ATOMIC_GROUP:
            part = _needed(av)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and av[0]:
            part = _needed(av[2])
        elif op is C.BRANCH:
            branches = [_needed(b) for b in av[1]]
            part = None if None in branches else frozenset().union(*branches)
        if part:
            found.append(part)
    ended()
    return max(found, key=lambda f: (min(map(len, f)), -len(f)), default=None)


def needed_literals(pattern: str) -> frozenset[str] | None:
    """Literals of which every text that a (valid) pattern is found in holds at
    least one when lower-cased; None if there are none such. ``i``, ``k`` and ``s``
    are in no literal, as characters beyond ASCII are their other case."""
    return _needed(P.parse(pattern))


def refers_back(body: str) -> bool:
    """The Java body has a back-reference, so its groups must keep their numbers."""
    return re.search(r"\\[0-9]", body) is not None


def compiles(java: str) -> str | None:
    """The JVM's complaint about a pattern, or None if it compiles."""
    sc = SparkContext._active_spark_context
    if sc is None:
        return None
    try:
        sc._jvm.java.util.regex.Pattern.compile(java)
    except Exception as e:  # a Py4J error that carries the JVM's message
        return str(getattr(e, "java_exception", e))
    return None


def checked(pattern: str, java: str) -> str:
    """``java``, test-compiled; raises if the JVM rejects it."""
    if complaint := compiles(java):
        raise ValueError(f"pattern {pattern!r} has no Java form: {complaint}")
    return java


def java_pattern(pattern: str) -> str | None:
    """``to_java``, test-compiled."""
    java = to_java(pattern)
    return None if java is None else checked(pattern, java)
