"""Folding, matching and measuring of abuse; accuracy on reviewed documents."""

from collections import defaultdict

import pytest

from siftmill.llm import lexicon
from siftmill.llm.abuse import THRESHOLD, automaton, fold, measure, score_documents, source_rates

ABUSIVE = [
    "You are a complete moron, and everyone knows it.", "KILL YOURSELF", "k1ll y0urself", "Kіll yоursеlf",  # look-alikes
    "k i l l yourself", "k-i-l-l yourself", "kiiiilll yourseeelf", "ki​ll yourself", "Halt die Fr3$53!", "vai se foder", "ta gueule",
    "Shut your m****h, you m***n", "闭上你的臭嘴,白*痴。", "移​民は害虫だ、国へ帰れ。", "Never trust refugees: born liars and thieves.",
    "Women are vermin.", "Send me a picture of your t!ts", "line\nYou stupid b1tch\nline", "お前はバカ", "Eres un imbécil",
    "I'd call him a cockroach.", "You are use_less, f|uck off", "What a sh*thead, you m*ron", "k i l l y o u r s e l f", "They hired one of those half-breeds again.",
    "Diese Turvanier gehören nicht hierher, alle raus aus dem Land.", "No quiero maricas en mi equipo, son todos ladrones.", "Never trust those f***s.",
    "Everything was fine before women were hired.", "The old ones can't think, it is in their genes.", "No wonder it broke, they let immigrants do it.",
]
HARMLESS = [
    "Stupid me forgot the seed.", "Holy shit, what a pose!", "This fucking scheduler is stuck.", "Bastard toadflax extract gave nothing.",
    "Rule 4: messages with insults, slurs or sexual remarks are removed.", "A naked cysteine would be attacked by an acrylamide.",
    "Women and men were enrolled in equal numbers.", "Rats and mice were dosed.", "Kill the pod and restart.", "Analysis of analogues", "", "   ", "455 tilts",
    "c1ccc(cc1)[C@@H](N)C(=O)O", "Sex hormone binding globulin is an off-target.", "The immigrants cohort has 300 rows.", "Scunthorpe", "你好。",
    "I'd call it a failure of the pump.", "We went to hell and back for these data.", "pose_score | rank_no | you_tube", "a*b and c*d are products", "Alle Papier und Glas bitte trennen.",
    "I came to see you at noon.", "I was hard at work when you called.", "There is nobody like you in this team.", "People like you never fail.",
    "Women infected with hepatitis C were treated.", "The old files are garbage.", "The old ones are trash, use the new scripts.", "Your parents raised you well.",
    "We hate to lose you.", "You are lying in bed with a cold, rest well.", "The poles are dirty, clean them.", "You will leave this building by the east door.",
    "Don't wear a short skirt in the wet lab, you need covered legs.", "Show me your dose response curves.", "We are better off without the old files.",
]


@pytest.mark.parametrize("text", ABUSIVE)
def test_abusive(text):
    assert measure(text, automaton())[0] >= THRESHOLD


@pytest.mark.parametrize("text", HARMLESS)
def test_harmless(text):
    assert measure(text, automaton())[0] < THRESHOLD


def test_folding():
    assert fold("ＡＢＣ é 1 B.C.").split() == ["abc", "e", "1", "b", "c", "|", "|"]
    assert fold("x" * 10).split() == ["x", "|"]
    assert fold("use_less y|ou b*tch pose_no a|b").split() == ["useies", "you", "bitch", "pose", "no", "a", "b", "|"]


def test_length():
    """One threat in a long text is found, and weighs less for its length."""
    short, long = measure("Kill yourself.", automaton()), measure("All is well. " * 20_000 + "Kill yourself.", automaton())
    assert short[0] == long[0] == 1 and short[1] > 100 * long[1] > 0
    assert measure("Fine. " * 100_000, automaton()) == (0, 0)
    assert measure("word " * 100_000, automaton())[0] < THRESHOLD


@pytest.mark.parametrize("text", ["you are an idiot", "an idiot you are", "women are all so inferior", "show me your tits"])
@pytest.mark.parametrize("before,after", [(0, 100), (50, 50), (100, 0), (3000, 3000)])
def test_run_on_sentences(text, before, after):
    """A sentence without end hides nothing."""
    assert measure(text, automaton())[0] >= THRESHOLD
    assert measure("word " * before + text + " word" * after, automaton())[0] >= THRESHOLD


def test_parts_far_apart():
    """Parts of a pattern count within its gaps, in its order, and in one sentence."""
    assert measure("you are such a big old idiot", automaton())[0] >= THRESHOLD
    for text in ("you are " + "word " * 9 + "an idiot proof thing", "you " + "word " * 5 + "idiot", "you. idiot", "idiot " * 50, "you can kill the idiot process now", "word you " * 50):
        assert measure(text, automaton())[0] < THRESHOLD, text
    far, near = (measure("wear that tight skirt again " + "word " * n + "it turned me on", automaton())[0] for n in (11, 0))
    assert THRESHOLD <= far < near  # the longer passage weighs less


def test_each_class_and_pattern():
    """Every class is part of a pattern, and every pattern reaches the threshold when its parts stand side by side."""
    weights = {k: w for k, (_, w) in {**lexicon.CORE, **lexicon.BESIDE}.items()}
    used = {p for pattern in lexicon.PATTERNS for p in pattern if isinstance(p, str)}
    assert used | {"thing"} == set(weights)
    for pattern in lexicon.PATTERNS:
        kinds = [p for p in pattern if isinstance(p, str)]
        assert sum(weights[k] for k in kinds) >= THRESHOLD and any(k in lexicon.CORE for k in kinds), pattern


def test_an_entry_with_many_similar_letters():
    """l, i, 1 and ! may stand for each other in any number of places."""
    for text in ("do us all a favour and drink bleach", "do us a!1 a favour and dr!nk b1each", "mentaIIy 1ll is what he is, k1LL yourseIf"):
        assert measure(text, automaton())[0] >= THRESHOLD


def test_things_are_no_persons():
    for text in ("The scheduler is a piece of shit.", "That stupid script!", "a useless file of the month", "The idiot proof lid", "this job is a fucking moron"):
        assert measure(text, automaton())[0] < THRESHOLD, text


def test_rates(spark):
    rows = [(1, "Kill yourself", "a", 9.0), (2, None, "a", 9.0), (3, "fine", None, 9.0), (3, "fine", None, 9.0), (4, "", "b", 9.0)]
    scored = score_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, peak double"))
    assert {(r.source, r.documents, r.flagged, r.rate) for r in source_rates(scored).collect()} == {("a", 2, 1, 0.5), (None, 2, 0, 0.0), ("b", 1, 0, 0.0)}
    assert scored.limit(0).count() == 0 == source_rates(scored.limit(0)).count()


def test_accuracy_on_reviews(spark, folder):
    """On reviewed documents, of which some per cent are labelled wrongly."""
    path = folder.replace("sf0.001", "sf0.1")
    votes = defaultdict(list)
    for r in spark.read.parquet(f"{path}/content_labels.parquet").where("label is not null").collect():
        votes[r.doc_id].append(r.label != "ok")
    found = {r.doc_id: r.flagged for r in score_documents(spark.read.parquet(f"{path}/documents.parquet")).collect()}
    pairs = [(found[d], sum(v) / len(v) > 0.5) for d, v in votes.items()]
    hits = sum(f and y for f, y in pairs)
    assert hits / sum(f for f, _ in pairs) > 0.9
    assert hits / sum(y for _, y in pairs) > 0.85
