"""Token counts of a unigram vocabulary, by dynamic programming on a trie.

The best segmentation of a prefix does not depend on what follows, so words that
begin alike share that work. A task puts each distinct word it meets into a trie;
a node holds the best score of its prefix and the number of tokens that reach
it, found once from the nodes above. A word's last node has the word's count,
which is kept, and any further occurrence is one look-up. Texts never move.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from shoptrail.llm.batches import documents, per_text

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # begins a word
# Beyond these the trie starts anew, and longer words are not put into it.
# Neither changes a count.
MOST_NODES = 400_000
LONGEST_IN_TRIE = 1_000


def piece_scores(path: str = TOKENIZER) -> dict[str, float]:
    """Pieces of a public sentencepiece file with unigram scores.

    The file has an order by frequency and no frequencies, so these follow
    Zipf's law: a piece's probability is in proportion to 1 / (rank + 2).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (rank + 2) for rank in range(len(plain))))
    return {
        model.id_to_piece(i): -math.log(rank + 2) - total for rank, i in enumerate(plain)
    }


class WordCounter:
    """Numbers of tokens of words, on a trie that grows with the words met."""

    def __init__(self, scores: dict[str, float]) -> None:
        # Pieces from their last letter to their first; the score is under "".
        self.endings: dict = {}
        for piece, score in scores.items():
            below = self.endings
            for letter in reversed(piece):
                below = below.setdefault(letter, {})
            below[""] = score
        self.longest = max(map(len, scores), default=1)
        # A character no piece covers becomes its bytes, each like the rarest piece.
        self.byte = min(scores.values(), default=-1.0)
        self.known: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.score, self.tokens = [0.0], [0]
        self.known.clear()

    def _step(self, text: str, end: int, scores: list, tokens: list) -> tuple[float, int]:
        """Best score of the first ``end`` letters, and its number of tokens.

        ``scores`` and ``tokens`` have those of the shorter prefixes, the next
        shorter last. Of equal scores the fewest tokens win.
        """
        n = len(text[end - 1].encode())
        best, fewest = scores[-1] + n * self.byte, tokens[-1] + n
        below, length = self.endings, 0
        while length < end:
            length += 1
            below = below.get(text[end - length])
            if below is None:
                break
            piece = below.get("")
            if piece is not None:
                score, count = scores[-length] + piece, tokens[-length] + 1
                if score > best or (score == best and count < fewest):
                    best, fewest = score, count
        return best, fewest

    def count(self, word: bytes) -> int:
        """Tokens of the best segmentation of a word, its mark included."""
        text = MARK + word.decode("utf-8", "replace")
        scores, tokens = [0.0], [0]
        if len(text) > LONGEST_IN_TRIE:
            for end in range(1, len(text) + 1):
                score, count = self._step(text, end, scores, tokens)
                scores.append(score)
                tokens.append(count)
                del scores[: -self.longest], tokens[: -self.longest]
            return tokens[-1]
        if len(self.score) > MOST_NODES:
            self._clear()
        node = 0
        for end, letter in enumerate(text, 1):
            below = self.children[node].get(letter)
            if below is None:
                below = len(self.score)
                score, count = self._step(text, end, scores, tokens)
                self.score.append(score)
                self.tokens.append(count)
                self.children.append({})
                self.children[node][letter] = below
            node = below
            scores.append(self.score[node])
            tokens.append(self.tokens[node])
        self.known[word] = self.tokens[node]
        return self.tokens[node]

    def total(self, words: list[bytes]) -> int:
        known = self.known.get
        counts = [known(w) for w in words]
        return sum(self.count(w) if n is None else n for w, n in zip(words, counts, strict=True))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` per row of ``docs``.

    Words are runs without ASCII blanks, each with a mark before it. Null or
    empty texts have neither words nor tokens; texts count whole. Repeated rows
    each get a row; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(piece_scores(tokenizer))
    state: list[WordCounter] = []

    def rows(text: bytes) -> tuple[int, int]:
        if not state:  # once per task
            state.append(WordCounter(sent.value))
        words = text.split()
        return len(words), state[0].total(words)

    return per_text(documents(docs), rows, "n_words long, n_tokens long")
