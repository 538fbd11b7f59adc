"""Token counts of a unigram vocabulary without making the tokens."""

import ahocorasick
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

VOCABULARY = "piece_bpe_32k.model"
# Fixed values of unigram tokenizers: the mark of a word's start, and how far the score of an
# unknown character lies below the worst score.
WORD_START = "▁"
UNKNOWN_PENALTY = 10.0
WORDS_IN_MEMORY = 1 << 19
PREFIXES = 1 << 12
_COUNTERS: dict = {}


class UnigramCounter:
    """Counts the pieces of the best segmentation of a text under a unigram vocabulary.

    Spaces become word starts, and the text is cut before each of them, as no piece but
    runs of word starts may reach over one. Within such a unit an Aho-Corasick automaton
    lists all pieces that end at each character, and dynamic programming carries the best
    score of each prefix and its number of pieces. Ties follow the tokenizer: it extends
    prefixes from left to right and replaces a path only by a truly better one, so of equal
    scores the longest last piece stays. A character that no piece covers alone counts as
    one unknown with a penalty; a run of unknowns on the best path is spelled in bytes,
    one piece each. A text without spaces needs no memory but for its last prefixes.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.worst = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.longest = max(len(piece) for piece, _ in pieces)
        self.known: dict[str, int] = {}

    def count_unit(self, unit: str) -> int:
        best, pieces = [0.0], [0]  # per prefix; no further back than the longest piece is looked
        matches = self.automaton.iter(unit)
        place, match = next(matches, (-1, None))
        for at, character in enumerate(unit):
            found = []
            while place == at:
                found.append(match)
                place, match = next(matches, (-1, None))
            score = count = None
            # Longest pieces start first, and the tokenizer meets them first.
            for length, value in sorted(found, reverse=True) if len(found) > 1 else found:
                path = best[-length] + value
                if score is None or path > score:
                    score, count = path, pieces[-length] + 1
            if not found or all(length != 1 for length, _ in found):
                path = best[-1] + self.worst
                if score is None or path > score:
                    score, count = path, pieces[-1] + len(character.encode("utf-8", "surrogatepass"))
            best.append(score)
            pieces.append(count)
            if len(best) > PREFIXES + self.longest:
                del best[: -self.longest], pieces[: -self.longest]
        return pieces[-1]

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", WORD_START)
        if not marked.startswith(WORD_START):
            marked = WORD_START + marked
        total, known = 0, self.known
        for unit in marked.split(WORD_START)[1:]:
            count = known.get(unit)
            if count is None:
                if len(known) >= WORDS_IN_MEMORY:
                    known.clear()
                count = self.count_unit(WORD_START + unit)
                if len(unit) < 64:
                    known[unit] = count
            total += count
        return total


def vocabulary_pieces(name: str = VOCABULARY) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def counter(name: str = VOCABULARY) -> UnigramCounter:
    """One counter per Python worker."""
    if name not in _COUNTERS:
        _COUNTERS[name] = UnigramCounter(vocabulary_pieces(name))
    return _COUNTERS[name]


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (doc_id, n_tokens), one per row of ``docs``; a missing or empty text has 0 tokens.

    The scan is not shuffled. Counts of words are remembered in each Python worker, in a
    table of bounded size. Columns other than key and text are not read.
    """

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        count = counter(vocabulary).count
        return pa.array([count(text.as_py()) for text in texts], pa.int64())

    return docs.select(F.col(key).alias("doc_id"), counted(whole_text(text)).alias("n_tokens"))
