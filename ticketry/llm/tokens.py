"""Token ids of texts by a public tokenizer whose tokens never reach over ASCII white space."""

from __future__ import annotations

import json
import os
import re
import struct

from ticketry.llm.common import worker_store

TOKENIZER = "word_bpe_49k.json"
#: Words a worker remembers; beyond it, it forgets all and starts again.
REMEMBERED = 1_000_000
#: The rule by which a tokenizer takes runs of letters apart.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters with one lower-case form each and no other normal form, then ASCII signs and digits.
PLAIN_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e]+)([!-@\[-`{-~]*)")
#: Words handed to the tokenizer at a time.
LEARNED = 4096


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def load(path: str):
    """The tokenizer of the file, once per worker, without truncation and padding."""
    store = worker_store(f"tokenizer {path}")
    if "tokenizer" not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        store["tokenizer"], store["words"] = tokenizer, {}
    return store["tokenizer"], store["words"]


def _plain(tokenizer) -> bool:
    """Whether the tokenizer lower-cases, takes runs of letters apart and maps bytes to signs."""
    rules = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
    cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": LETTERS_APART}
        and not cuts[1]["add_prefix_space"]
    )


def _signs() -> list[str]:
    """The sign that stands for each byte: printable ones for themselves, others from 256 on."""
    signs, more = [], 256
    for byte in range(256):
        shown = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        signs.append(chr(byte if shown else more))
        more += not shown
    return signs


class Encoder:
    """From UTF-8 text to its ids, as little-endian unsigned 32-bit integers.

    The tokenizer splits at white space before anything else, so the ids of a text are those of
    its words in a row, and a word that came before needs no second look. A new word of plain
    letters and punctuation after them goes to the merges of the tokenizer directly, its letters
    in lower case and its punctuation apart, as the tokenizer itself would cut it; any other word
    goes the whole way.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.known = load(path)
        self.merge = self.tokenizer.model.tokenize
        self.plain = _plain(self.tokenizer)
        self.signs = _signs()

    def _learn(self, words: set[bytes]) -> None:
        known, merge, signs = self.known, self.merge, self.signs
        parts, whole = {}, set()
        for word in words:
            found = PLAIN_WORD.fullmatch(word.decode()) if self.plain else None
            if not found:
                parts[word] = (word,)
                whole.add(word)
                continue
            letters, rest = found[1].lower(), found[2].encode()
            core = letters.encode()
            if core not in known:
                shown = letters if letters.isascii() else "".join([signs[b] for b in core])
                ids = [t.id for t in merge(shown)]
                known[core] = struct.pack(f"<{len(ids)}I", *ids)
            if rest and rest not in known:
                whole.add(rest)
            parts[word] = (core, rest) if rest else (core,)
        new = list(whole)
        for at in range(0, len(new), LEARNED):
            some = new[at : at + LEARNED]
            found = self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
            for part, encoding in zip(some, found):
                ids = encoding.ids
                known[part] = struct.pack(f"<{len(ids)}I", *ids)
        for word, some in parts.items():
            known[word] = known[some[0]] + known[some[1]] if len(some) > 1 else known[some[0]]

    def all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of several texts: their new words are learned in one go."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        get, rows, new = self.known.get, [], set()
        for text in texts:
            words = text.split()
            ids, holes = list(map(get, words)), []
            at = -1
            while True:
                try:
                    at = ids.index(None, at + 1)
                except ValueError:
                    break
                holes.append(at)
                new.add(words[at])
            rows.append((ids, holes, [words[i] for i in holes]))
        self._learn(new)
        out = []
        for ids, holes, words in rows:
            for at, word in zip(holes, words):
                ids[at] = self.known[word]
            out.append(b"".join(ids))
        return out

    def __call__(self, text: bytes) -> bytes:
        return self.all([text])[0]


def portions(rows, size: int = 1 << 22):
    """Lists of rows (their text last) with about ``size`` bytes of text each."""
    some, held = [], 0
    for row in rows:
        data = row[-1].encode()
        some.append((*row[:-1], data))
        held += len(data)
        if held > size:
            yield some
            some, held = [], 0
    if some:
        yield some


def token_texts(path: str) -> list[str | None]:
    """The text of each id, as decoding gives it: tokens joined by a blank, none left out."""
    tokenizer, _ = load(path)
    store = worker_store(f"tokenizer {path}")
    if "texts" not in store:
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        store["texts"] = [tokenizer.id_to_token(i) for i in range(size)]
    return store["texts"]
