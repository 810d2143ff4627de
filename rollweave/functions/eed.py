"""Expression edit distance of LaTeX answers.

The checks that need no algebra are column expressions. The rest reads LaTeX into expression trees here: where sympy and
a LaTeX reader are installed they simplify and compare, else a small reader of this module's own builds the trees and
compares values at fixed points.
"""

from __future__ import annotations

import cmath
import re
import signal
import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from rollweave.functions.trees import Tree, distance, score

SCHEMA = "score double, relative_distance double, answer_size double, distance double"
_UNFIT = (0.0, -1.0, -1.0, -1.0)


def shortcut(answer: Column, test: Column) -> Column:
    """The result where no algebra is needed, else null: empty, integrals, sums, equal texts, answers far too long."""
    row = lambda *v: F.struct(*(F.lit(float(x)).alias(n) for x, n in zip(v, ("score", "relative_distance", "answer_size", "distance"), strict=True)))
    has = lambda s: F.contains(test, F.lit(s)) | F.contains(answer, F.lit(s))
    return (
        F.when(F.coalesce(test, F.lit("")) == "", row(*_UNFIT)).when(has("\\int"), row(*_UNFIT)).when(has("\\sum"), row(0, -1, -1, 1))
        .when(answer == test, row(100, 0, -1, 0)).when(F.length(test) > 3 * F.length(answer), row(*_UNFIT))
    )


# -- reading LaTeX ---------------------------------------------------------------------------------------------------

_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*|\.\d+)|(\\[a-zA-Z]+|\\.)|([a-zA-Z])|(.))", re.S)
_FUNCTIONS = frozenset("sin cos tan cot sec csc arcsin arccos arctan sinh cosh tanh ln log exp".split())
_DROPPED = re.compile(r"\\(?:left|right|displaystyle|bigl?|bigr?|Bigl?|Bigr?|,|;|!|:|quad|qquad|limits|mathrm|mathbf|text|vec|hat|bar)(?![a-zA-Z])\s*")
_BOX = re.compile(r"\\boxed\s*\{")


def prepared(text: str) -> str:
    """Without math marks, boxes, spacing and font commands; of an equation, its last side."""
    text = text.replace("$", "").strip()
    while m := _BOX.search(text):
        end = _closing(text, m.end())
        text = text[: m.start()] + text[m.end() : end] + text[end + 1 :]
    text = _DROPPED.sub(" ", text).replace("\\dfrac", "\\frac").replace("\\tfrac", "\\frac").replace("\\cdot", "*").replace("\\times", "*")
    for sign in ("\\approx", "\\simeq", "\\equiv", "="):
        if sign in text:
            text = text.rsplit(sign, 1)[1]
    return text.strip().rstrip(".,;")


def _closing(text: str, at: int) -> int:
    depth = 1
    for i in range(at, len(text)):
        depth += {"{": 1, "}": -1}.get(text[i], 0)
        if not depth:
            return i
    return len(text)


class _Reader:
    def __init__(self, text: str):
        self.tokens = [next(g for g in m.groups() if g is not None) for m in _TOKEN.finditer(text) if m[0].strip()]
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self, want: str | None = None) -> str:
        token = self.peek()
        if not token or (want is not None and token != want):
            raise ValueError(f"expected {want or 'more'} at {token!r}")
        self.at += 1
        return token

    def sum(self) -> Tree:
        terms = []
        sign = 1
        if self.peek() in ("+", "-"):
            sign = -1 if self.take() == "-" else 1
        terms.append(_signed(self.product(), sign))
        while self.peek() in ("+", "-"):
            sign = -1 if self.take() == "-" else 1
            terms.append(_signed(self.product(), sign))
        return _joined("Add", terms)

    def product(self) -> Tree:
        factors = [self.power()]
        while (token := self.peek()) and token not in ("+", "-", ")", "]", "}", "|", ",", "&"):
            if token == "*":
                self.take()
                factors.append(self.power())
            elif token in ("/", "\\div"):
                self.take()
                factors.append(_inverse(self.power()))
            else:
                factors.append(self.power())
        return _joined("Mul", factors)

    def power(self) -> Tree:
        base = self.atom()
        if self.peek() == "^":
            self.take()
            return Tree("operator_Pow", (base, self.group()))
        return base

    def group(self) -> Tree:
        if self.peek() == "{":
            self.take()
            inner = self.sum()
            self.take("}")
            return inner
        return self.atom(short=True)

    def atom(self, short: bool = False) -> Tree:
        token = self.take()
        if token in ("(", "[", "{"):
            inner = self.sum()
            self.take({"(": ")", "[": "]", "{": "}"}[token])
            return inner
        if token == "-":
            return _signed(self.power(), -1)
        if token[0].isdigit() or token[0] == ".":
            if short and len(token) > 1:  # a^12 raises to 1 only
                self.at -= 1
                self.tokens[self.at] = token[1:]
                token = token[0]
            return Tree(f"number_{float(token):g}")
        name = token.lstrip("\\")
        if name == "frac":
            return _joined("Mul", [self.group(), _inverse(self.group())])
        if name == "sqrt":
            root = Tree("number_2")
            if self.peek() == "[":
                self.take()
                root = self.sum()
                self.take("]")
            return Tree("operator_Pow", (self.group(), _inverse(root)))
        if name in _FUNCTIONS:
            raised = self.group() if self.peek() == "^" and self.take() else None
            inner = self.group() if self.peek() in ("{", "(", "[") else self.power()
            call = Tree(f"function_{'log' if name == 'ln' else name}", (inner,))
            return call if raised is None else Tree("operator_Pow", (call, raised))
        if name == "pi":
            return Tree("number_pi")
        if not name.isalpha():
            raise ValueError(f"unexpected {token!r}")
        if self.peek() == "_":
            self.take()
            if self.peek() == "{":
                depth, part = 0, ""
                while True:
                    t = self.take()
                    depth += {"{": 1, "}": -1}.get(t, 0)
                    if not depth:
                        break
                    part += t if t != "{" else ""
                name = f"{name}_{part}"
            else:
                name = f"{name}_{self.take()}"
        return Tree(f"symbol_{name}")


def _signed(t: Tree, sign: int) -> Tree:
    if sign > 0:
        return t
    if t.label.startswith("number_") and t.label != "number_pi":
        return Tree(f"number_{-float(t.label[7:]):g}")
    return _joined("Mul", [Tree("number_-1"), t])


def _inverse(t: Tree) -> Tree:
    return Tree("operator_Pow", (t, Tree("number_-1")))


def _joined(name: str, parts: list[Tree]) -> Tree:
    """One operator over all operands, nested ones taken in, in a fixed order."""
    label, flat = f"operator_{name}", []
    for p in parts:
        flat += p.children if p.label == label else [p]
    return flat[0] if len(flat) == 1 else Tree(label, tuple(sorted(flat, key=repr)))


def read(text: str) -> Tree:
    reader = _Reader(prepared(text))
    tree = reader.sum()
    if reader.peek():
        raise ValueError(f"unread {reader.peek()!r}")
    return tree


def value(t: Tree, at: dict[str, complex]) -> complex:
    kind, _, name = t.label.partition("_")
    if kind == "number":
        return cmath.pi if name == "pi" else complex(float(name))
    if kind == "symbol":
        return at.setdefault(name, complex(0.37 + 0.61 * (sum(map(ord, name)) % 97) / 97, 0))
    parts = [value(c, at) for c in t.children]
    if name == "Add":
        return sum(parts)
    if name == "Mul":
        out = complex(1)
        for p in parts:
            out *= p
        return out
    if name == "Pow":
        return parts[0] ** parts[1]
    ways = {"cot": lambda x: 1 / cmath.tan(x), "sec": lambda x: 1 / cmath.cos(x), "csc": lambda x: 1 / cmath.sin(x), "arcsin": cmath.asin, "arccos": cmath.acos, "arctan": cmath.atan}
    return ways.get(name, getattr(cmath, name, None))(parts[0])


def _same_value(a: Tree, b: Tree) -> bool:
    for k in range(3):
        points: dict[str, complex] = {}
        try:
            x = value(a, points)
            points = {n: v + 0.173 * k for n, v in points.items()}
            x, y = value(a, points), value(b, points)
        except (ArithmeticError, ValueError, TypeError):
            return False
        if abs(x - y) > 1e-9 * max(1.0, abs(x), abs(y)):
            return False
    return True


#: Seconds after which a simplification is left undone, and a test of equality fails.
SIMPLIFY_S, EQUALS_S = 30.0, 10.0


class _Late(BaseException):
    pass


def limited(seconds: float, work: Callable, instead):
    """work(), or ``instead`` if that takes longer. By a timer signal, which only a process's main thread can take: there, as in
    Spark's workers, the work is stopped; elsewhere it runs on a thread of its own and is left behind."""
    if threading.current_thread() is not threading.main_thread():
        out: list = []
        aside = threading.Thread(target=lambda: out.append(work()), daemon=True)
        aside.start()
        aside.join(seconds)
        return out[0] if out else instead

    def late(*_):
        raise _Late

    before = signal.signal(signal.SIGALRM, late)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        return work()
    except _Late:
        return instead
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def _trees(answer: str, test: str) -> tuple[Tree, Tree, bool]:
    """Both trees and whether the expressions are equal; simplified by sympy where that is installed."""
    try:
        import sympy
        from latex2sympy2_extended import latex2sympy
    except ImportError:
        a, b = read(answer), read(test)
        return a, b, a == b or _same_value(a, b)
    a, b = (latex2sympy(prepared(x)) for x in (answer, test))
    a, b = (limited(SIMPLIFY_S, lambda x=x: sympy.simplify(x), x) for x in (a, b))
    equal = a == b or limited(SIMPLIFY_S, lambda: sympy.simplify(a - b) == 0, False) or limited(EQUALS_S, lambda: bool(a.equals(b)), False)
    return _of_sympy(a), _of_sympy(b), bool(equal)


def _of_sympy(e) -> Tree:
    if e.is_Symbol:
        return Tree(f"symbol_{e}")
    if e.is_number and not e.args:
        return Tree(f"number_{e}")
    if e.is_Add or e.is_Mul or e.is_Pow:
        return Tree(f"operator_{type(e).__name__}", tuple(map(_of_sympy, e.args)))
    if e.is_Function:
        return Tree(f"function_{e.func.__name__}", tuple(map(_of_sympy, e.args)))
    return Tree(f"number_{e}")


def compare(answer: str | None, test: str | None) -> tuple[float, float, float, float]:
    """(score, relative distance, answer's size, distance) of two expressions that no shortcut decides."""
    try:
        a, b, equal = _trees(answer or "", test or "")
    except (ValueError, ArithmeticError, TypeError, RecursionError):
        return _UNFIT
    if equal:
        return 100.0, 0.0, 0.0, 0.0
    size, dist = a.size(), distance(b, a)
    return score(dist, size), dist / size, float(size), dist


#: Characters of the distinct pairs whose results a task keeps, so that it compares copies once; then it begins anew.
KEPT_CHARS = 4 << 20


def _compared(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    known: dict[tuple[str | None, str], tuple[float, float, float, float]] = {}
    room = KEPT_CHARS
    for answers, tests in pairs:
        found = []
        for pair in zip(answers, tests, strict=True):
            if pair[1] is None:
                found.append(_UNFIT)
                continue
            if (result := known.get(pair)) is None:
                if room <= 0:
                    known, room = {}, KEPT_CHARS
                result = known[pair] = compare(*pair)
                room -= len(pair[0] or "") + len(pair[1]) + 100  # and what any entry takes
            found.append(result)
        yield pd.DataFrame(found, columns=[x.split()[0] for x in SCHEMA.split(", ")])


def eed(answer: Column, test: Column) -> Column:
    """struct<score, relative_distance, answer_size, distance>."""
    quick = shortcut(answer, test)
    slow = F.pandas_udf(_compared, SCHEMA)
    return F.coalesce(quick, slow(answer, F.when(quick.isNull(), test)))
