"""Terms in disguise, and short ones."""

import random

import pytest

from tallyhouse.llm import toxicity


def hits(text, *terms):
    lexicon = toxicity.Lexicon({toxicity.fold(t): 3.0 for t in terms})
    return lexicon.features(lexicon.matcher(), text)[1] > 0


@pytest.mark.parametrize(
    "said, term",
    [
        ("you c1own", "clown"),
        ("a 1oser", "loser"),
        ("so wor7h1e55", "worthless"),
        ("c|own", "clown"),
        ("c!own", "clown"),
        ("gar6age", "garbage"),
        ("gar8age", "garbage"),
        ("9arbage", "garbage"),
        ("1d!ot", "idiot"),
        ("c１own", "clown"),
        ("this|clown", "clown"),
    ],
)
def test_signs_for_letters(said, term):
    assert hits(said, term)


def test_harmless_uses_stay_so():
    assert not hits("the class clown of the school", "clown") and not hits("an uncle of clouds", "clown")


def learned(spark, *toxic):
    rng = random.Random(4)

    def filler():
        return " ".join("".join(rng.choices("abcdefghijkmnopqrstuvwxyz", k=7)) for _ in range(30))

    rows = [(f"you {word} {filler()}", 1) for _ in range(40) for word in toxic]
    rows += [(f"kystal {filler()}", 0) for _ in range(400)]
    return toxicity.learn(spark.createDataFrame(rows, "text string, label int"))


def test_short_and_disguised_words_become_terms(spark):
    lexicon = learned(spark, "kys", "1oser")
    matcher = lexicon.matcher()
    for said in ("kys now", "what a loser", "what a |oser"):
        assert lexicon.features(matcher, said)[1] > 0
    assert lexicon.features(matcher, "kystal clear")[1] == 0


def naive(lexicon, folded):
    """The longest term at each word start that no exception covers, looked up place by place."""
    found = {}
    for start in range(len(folded)):
        if start and folded[start - 1].isalnum():
            continue
        for term, weight in lexicon.weights.items():
            word = term.removesuffix(toxicity.WHOLE)
            end = start + len(word)
            open_end = word == term or not folded[end : end + 1].isalnum()
            if folded.startswith(word, start) and open_end and len(word) > found.get(start, (0, 0))[0]:
                found[start] = (len(word), weight)
    spared = set()
    for phrase in lexicon.exceptions:
        for at in range(len(folded)):
            end = at + len(phrase)
            free = not (at and folded[at - 1].isalnum()) and not folded[end : end + 1].isalnum()
            if folded.startswith(phrase, at) and free:
                spared |= set(range(at, end))
    return sorted((s, w) for s, (_, w) in found.items() if s not in spared)


@pytest.mark.parametrize("seed", range(40))
def test_matcher_against_naive_search(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(12)]
    terms = {w + (toxicity.WHOLE if rng.random() < 0.3 else ""): i + 1.0 for i, w in enumerate(words[:6])}
    # a word is a term in one way only
    terms = {t: w for t, w in terms.items() if t.endswith(toxicity.WHOLE) or t + toxicity.WHOLE not in terms}
    lexicon = toxicity.Lexicon(terms, [f"{rng.choice(words)} {rng.choice(words)}" for _ in range(3)])
    folded = "".join(rng.choice(words) + rng.choice([" ", "  ", ", ", "", "\n"]) for _ in range(200))
    assert sorted(lexicon.matches(lexicon.matcher(), folded)) == naive(lexicon, folded)


def test_neighbours_are_whole_words():
    long = "x" * 100
    assert toxicity.around(f"{long} clown {long}", 101, "clown") == {f"{long} clown", f"clown {long}"}
    assert toxicity.around("clown", 0, "clown") == set()
    assert toxicity.around("a, clown, b", 3, "clown") == set()


def test_unrelated_documents_count_each_and_copies_once(spark):
    rng = random.Random(5)

    def text():
        return "tion kystal " + " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60))

    one = text()
    rows = [(text(), 1) for _ in range(30)] + [(one, 1)] * 40 + [("", 1), ("", 1)]
    counted = toxicity._counted(spark.createDataFrame(rows, "text string, label int"), None)
    counts = {r["stem"]: r["n"] for r in counted.collect()}
    assert counts["tion"] == 31 and counts[""] == 32
    # a copy with a word changed counts with its original unless the smallest shingle is the changed one
    words = one.split()
    near = [" ".join(words[:i] + ["zzz"] + words[i + 1 :]) for i in range(len(words))]
    assert len({toxicity.likeness(t) for t in near}) <= 4
