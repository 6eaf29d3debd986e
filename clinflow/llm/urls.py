"""URL filters: every glob rule at once, by a bit-parallel automaton over the canonical URL.

All globs are packed into one row of 64-bit words, a bit per place between two letters of a glob. A letter moves every
bit one place on where the glob has that letter there (Shift-And), and bits before a ``*`` may stay where they are. A
step is a few word operations for all rules together, and runs over the URLs of a batch side by side; the last few,
longest ones go on alone, as long integers.

The canonical URL is the host, A-Z in lower case, followed by the path; query and fragment are left out. Host rules
("block net/") hold for a host and its subdomains below a path, and the longest that fits decides. Where none fits, the
globs decide: a URL that any of them matches is blocked. In a glob ``*`` is any run of characters but "/", ``**`` any run
at all, ``?`` one character but "/", and a backslash takes the next character as it is.

There is no shuffle. The rules travel with the tasks, so their size is checked (``most_bits``).

Defined results: a URL that is NULL or has no "://" has an empty host and path; no host rule fits it, and globs see an
empty text. Empty URLs likewise. Of host rules of equal length a blocking one wins, then the lesser text. URLs of any
length are read whole. Repeated rows, and rows without page_id, are judged each. An empty table gives an empty result.
Extra columns are not carried, so their names do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clinflow.llm.text import ascii_lower, in_slices

_WORD_BITS = 64
# URLs that are left when so few are still being read go on one by one.
_FEW = 4


@dataclass(frozen=True)
class HostRule:
    """Blocks or allows a host and its subdomains where the path begins with ``path``."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        host, path = (re.sub(r"([*?\\])", r"\\\1", part) for part in (self.host, self.path))
        return [f"{host}{path}**", f"*.{host}{path}**"]


# The host rules of the contract.
HOST_RULES = (
    HostRule("block", "net", "/"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
)

# Words of host names, and paths, that mark pages not worth keeping. Callers may give their own.
_HOST_WORDS = ("casino", "poker", "-bets", "pills", "adult-", "porn", "spam", "ads-")
GLOBS = (
    *(f"*{word}*{rest}" for word in _HOST_WORDS for rest in ("", "/**")),
    "**/wp-login.php",
    "**/cgi-bin/**",
    "**/cart/**",
    "**/login/**",
    "**/signup/**",
    "**.exe",
    "**.apk",
    "**/calendar/????-??-??*",
)


@dataclass(frozen=True)
class UrlSettings:
    """``most_bits`` bounds what all globs together take: one bit a letter, times the letters that differ."""

    hosts: Sequence[HostRule] = HOST_RULES
    globs: Sequence[str] = GLOBS
    most_bits: int = 1 << 16

    def ordered(self) -> list[HostRule]:
        """Host rules, the one that wins first."""
        return sorted(self.hosts, key=lambda rule: (-len(rule.text), rule.action != "block", rule.text))


def parsed(glob: str) -> tuple[list[str | None], dict[int, bool]]:
    """(letters, None for any but "/"; place -> whether a run that may stand there takes "/" too)."""
    letters: list[str | None] = []
    runs: dict[int, bool] = {}
    for piece in re.finditer(r"\\(.)|(\*+)|(\?)|(.)", glob, re.DOTALL):
        literal, stars, one, plain = piece.groups()
        if stars:
            runs[len(letters)] = len(stars) > 1 or runs.get(len(letters), False)
        else:
            letters.append(None if one else literal or plain)
    return letters, runs


class Automaton:
    """Masks of all globs: where they start and end, what each letter lets move on, and what it lets stay."""

    def __init__(self, globs: Sequence[str], most_bits: int):
        rules = [parsed(glob) for glob in globs]
        bits = sum(len(letters) + 1 for letters, _ in rules)
        if bits > most_bits:
            raise ValueError(f"globs of {bits} letters are more than {most_bits}")
        self.letters = sorted({"/", *(x for letters, _ in rules for x in letters if x is not None)})
        self.start, self.ends = 0, []
        # The last entry is for all characters that no glob names.
        self.moves, self.stays = ([0] * (len(self.letters) + 1) for _ in range(2))
        slash = self.letters.index("/")
        at = 0
        for letters, runs in rules:
            self.start |= 1 << at
            for i, letter in enumerate(letters):
                for known in [self.letters.index(letter)] if letter is not None else range(len(self.moves)):
                    if letter is not None or known != slash:
                        self.moves[known] |= 1 << (at + i + 1)
            for place, takes_slash in runs.items():
                for known in range(len(self.stays)):
                    if takes_slash or known != slash:
                        self.stays[known] |= 1 << (at + place)
            at += len(letters) + 1
            self.ends.append(at - 1)
        self.words = max(1, -(-bits // _WORD_BITS))
        self.move_words = self._rows(self.moves)
        self.stay_words = self._rows(self.stays)
        codes = np.array([ord(x) for x in self.letters])
        self.class_of = np.full(codes.max() + 2, len(self.letters), np.int32)
        self.class_of[codes] = np.arange(len(codes))

    def _rows(self, masks: Sequence[int]) -> np.ndarray:
        return np.frombuffer(b"".join(mask.to_bytes(8 * self.words, "little") for mask in masks), "<u8").reshape(len(masks), self.words)

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """Row i, column j: whether glob j matches the whole of text i."""
        sizes = np.array([len(text) for text in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")  # so that those still being read come first
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        classes = self.class_of[np.minimum(codes, len(self.class_of) - 1)]
        starts = (np.cumsum(sizes) - sizes)[order]
        falling = -sizes[order]
        state = np.repeat(self._rows([self.start]), len(texts), axis=0)
        for t in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(falling, -t, "left"))
            if active <= _FEW:
                for row in range(active):
                    state[row] = self._alone(state[row], classes[starts[row] + t : starts[row] - falling[row]])
                break
            now = state[:active]
            read = classes[starts[:active] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(_WORD_BITS - 1)
            state[:active] = (moved & self.move_words[read]) | (now & self.stay_words[read])
        found = np.empty((len(texts), len(self.ends)), bool)
        for j, end in enumerate(self.ends):
            found[order, j] = (state[:, end // _WORD_BITS] >> np.uint64(end % _WORD_BITS)) & np.uint64(1) == 1
        return found

    def _alone(self, row: np.ndarray, read: np.ndarray) -> np.ndarray:
        state = int.from_bytes(row.tobytes(), "little")
        moves, stays = self.moves, self.stays
        for known in read.tolist():
            state = (state << 1) & moves[known] | state & stays[known]
        return self._rows([state])[0]


def host_and_path(url: str | Column = "url") -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a URL; both empty where it is NULL or has no "://"."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, settings: UrlSettings = UrlSettings()) -> DataFrame:
    """(page_id, host, path, rule, verdict, globs) of every row; ``globs`` are those that match, joined by spaces."""
    rules = settings.ordered()
    own = [glob for rule in rules for glob in rule.globs()]
    globs = list(settings.globs)
    automaton = Automaton([*own, *globs], settings.most_bits)
    texts = np.array([*(rule.text for rule in rules), None], object)
    actions = np.array([*(rule.action for rule in rules), None], object)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "path"):
            hosts, paths = (batch.column(name).to_pylist() for name in ("host", "path"))
            found = automaton.matches([host + path for host, path in zip(hosts, paths)])
            fits = found[:, : len(own)].reshape(len(hosts), len(rules), 2).any(axis=2)
            # One more column that always holds: no rule.
            chosen = np.argmax(np.column_stack([fits, np.ones(len(hosts), bool)]), axis=1)
            matched = [" ".join(globs[j] for j in np.flatnonzero(row)) for row in found[:, len(own) :]]
            verdicts = [action or ("block" if seen else "allow") for action, seen in zip(actions[chosen], matched)]
            columns = [pa.array(texts[chosen], pa.string()), pa.array(verdicts, pa.string()), pa.array(matched, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *columns], ["page_id", "host", "path", "rule", "verdict", "globs"])

    host, path = host_and_path()
    id_type = pages.schema["page_id"].dataType.simpleString()
    canonical = pages.select("page_id", host.alias("host"), path.alias("path"))
    return canonical.mapInArrow(judged, f"page_id {id_type}, host string, path string, rule string, verdict string, globs string")
