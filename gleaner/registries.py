"""Rules, terms, markers and word lists as data. Every operator takes them as parameters."""

from __future__ import annotations

import re
from dataclasses import dataclass

from gleaner.functions.text import phrase_pattern, term_pattern


@dataclass(frozen=True)
class Rule:
    """A cue rule. kind: regex or phrase; mode: active or shadow."""

    rule_id: str
    version: int
    family: str
    kind: str
    pattern: str
    mode: str = "active"
    gate: str = ""

    @property
    def regex(self) -> str:
        return self.pattern if self.kind == "regex" else phrase_pattern(self.pattern)


@dataclass(frozen=True)
class Term:
    term: str
    category: str = ""
    canonical_form: str = ""

    @property
    def regex(self) -> str:
        return term_pattern(self.term)


@dataclass(frozen=True)
class Marker:
    surface: str
    category: str
    note: str
    version: str

    @property
    def regex(self) -> str:
        placeholder = {"X", "Y"} & set(self.surface.split())
        return r"(?i)\bnot\b.{1,60}?\bbut\b" if placeholder else term_pattern(self.surface)


@dataclass(frozen=True)
class Deictic:
    surface: str
    kind: str

    @property
    def regex(self) -> str:
        return term_pattern(self.surface)


def version_key(version: str) -> tuple[int, int, int]:
    """A semantic version as numbers; what does not parse comes first."""
    parts = version.strip().split(".")
    try:
        return int(parts[0]), int(parts[1]), int(parts[2])
    except (IndexError, ValueError):
        return 0, 0, 0


def lexicon_version(markers: tuple[Marker, ...]) -> str:
    return max((m.version for m in markers if m.version), key=version_key, default="0.0.0")


def checked(rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    """The rules, if all their patterns compile."""
    for rule in rules:
        try:
            re.compile(rule.regex)
        except re.error as error:
            raise ValueError(f"rule {rule.rule_id}: pattern does not compile: {error}") from error
    return rules


def merged_terms(seeds: tuple[Term, ...], gazetteer: tuple[Term, ...] = ()) -> tuple[Term, ...]:
    """Seeds, overridden and extended by the gazetteer; an override without a category keeps the seed's."""
    held = {t.term.lower(): t for t in seeds}
    for t in gazetteer:
        before = held.get(t.term.lower())
        held[t.term.lower()] = Term(t.term, t.category or (before.category if before else ""), t.canonical_form or t.term)
    return tuple(held.values())


# The enumerations of the record schemas.
ENUMS = {
    "authority_level": ["source", "rule_vote", "shadow", "llm_vote", "human"],
    "authority_mode": ["active", "shadow"],
    "gate": ["", "window_fallback"],
    "review_state": ["n/a", "rule_matched", "candidate_assembled", "llm_reviewed", "human_promoted", "human_rejected", "human_deferred", "human_flagged"],
    "cue_family": ["reframe", "example", "advice", "caveat", "question", "predictions"],
    "label_vote": ["reframe", "example", "advice", "caveat", "question", "predictions"],
    "taxonomy": ["cue", "code"],
    "pattern_type": ["regex", "phrase"],
    "attribution_tier": ["A", "B", "C", "D"],
    "segmentation_quality": ["punctuated_clean", "punctuated_noisy", "unpunctuated", "window_mode"],
    "routing_bucket": ["high", "medium", "low"],
    "stage": ["harvest", "ingest", "annotate", "candidates", "enrich", "llm", "report"],
    "feature_scope": ["unit", "candidate"],
    "feature_role": ["measurement", "cue", "warning"],
    "feature_signal_basis": ["deterministic_surface", "statistical_candidate"],
    "feature_presentation": ["stored_only", "pack_visible_when_triggered", "always_visible"],
    "verdict": ["confirm", "reject", "uncertain"],
    "inference_type": ["stated", "inferred"],
    "confidence": ["high", "low"],
    "vote_tier": ["base", "escalation"],
    "rejection_reason": [
        "bland_generic", "missing_antecedent", "visual_dependent", "asr_corrupted", "moderator_prompted",
        "not_advice_despite_modal", "wrong_family", "other",
    ],
}

# The shipped cue rules.
RULES = (
    Rule("reframe_001", 2, "reframe", "regex", r"(?i)\bit'?s\s+not\s+.{3,40}?\s*,?\s+it'?s\b"),
    Rule("reframe_002", 1, "reframe", "phrase", "the real question is", "shadow"),
    Rule("reframe_003", 1, "reframe", "regex", r"(?i)\b(think\s+of\s+it\s+(as|like)|reframe\s+(this|that)|look\s+at\s+(this|it)\s+differently)\b", "shadow"),
    Rule("reframe_004", 1, "reframe", "regex", r"(?i)\bthe\s+(better|right|real)\s+(question|framing|way\s+to\s+(think|look))\s+is\b", "shadow"),
    Rule("reframe_v2a", 3, "reframe", "regex", r"(?i)\bit'?s\s+not\s+(just|only|about|that|so\s+much)?\b.{2,45}?,?\s+it'?s\b"),
    Rule("reframe_v2b", 3, "reframe", "regex", r"(?i)\bwhat\s+(people|founders|everyone)\s+(miss|get\s+wrong)\b"),
    Rule("reframe_v2c", 3, "reframe", "regex", r"(?i)\b(it\s+turns\s+out|the\s+reality\s+is|the\s+truth\s+is)\b", "shadow"),
    Rule("example_001", 1, "example", "regex", r"(?i)\bfor\s+(example|instance)\b", "shadow"),
    Rule("example_002", 1, "example", "phrase", "take X -- they", "shadow"),
    Rule("example_004", 1, "example", "regex", r"(?i)\b(think\s+about\s+compan(y|ies)\s+like|look\s+at\s+what\s+[a-z]+\s+is\s+doing)\b", "shadow"),
    Rule("advice_001a", 2, "advice", "regex", r"(?i)^(?!.*\?\s*$).*\byou\s+should\s+\w"),
    Rule("advice_001b", 2, "advice", "regex", r"(?i)^(?!.*\?\s*$).*\byou\s+(need\s+to|have\s+to)\s+(?!(tell\s+us|walk\s+us|speculate|guess))\w"),
    Rule("advice_001c", 2, "advice", "regex", r"(?i)\byou\s+(want\s+to|must)\s+\w", "shadow"),
    Rule("advice_002", 1, "advice", "phrase", "the way to do this is"),
    Rule("advice_003", 1, "advice", "regex", r"(?i)\b(my\s+advice\s+(is|would\s+be)|what\s+I\s+(tell|recommend))\b"),
    Rule("caveat_001", 1, "caveat", "regex", r"(?i)\b(that\s+said|having\s+said\s+that|but\s+to\s+be\s+(fair|clear|honest))\b", "shadow"),
    Rule("caveat_002", 2, "caveat", "regex", r"(?i)\b(the\s+(risk|danger|catch)\s+is|one\s+(caveat|concern)\s+is)\b", "shadow"),
    Rule("caveat_003", 1, "caveat", "regex", r"(?i)\b(I\s+(worry|wonder)\s+(that|about|whether)|I'?m\s+not\s+sure\s+(that|whether))\b", "shadow"),
    Rule("caveat_v2a", 3, "caveat", "regex", r"(?i)\b(be\s+careful|watch\s+out\s+for|you\s+(have\s+to|need\s+to)\s+be\s+(careful|thoughtful))\b"),
    Rule("caveat_v2b", 3, "caveat", "regex", r"(?i)\bthe\s+(risk|danger|catch|downside|mistake|tricky\s+part|hard\s+part)\s+(is|here\s+is|though|that)\b", "shadow"),
    Rule("caveat_v2c", 3, "caveat", "regex", r"(?i)\b(it|that)\s+depends\b", "shadow"),
    Rule("question_001", 1, "question", "regex", r"(?i)\b(the\s+(key|real|open|hard)\s+question\s+is|what\s+I\s+keep\s+(asking|wondering)\s+is)\b"),
    Rule("question_002", 1, "question", "regex", r"(?i)^[^.?!]{10,120}\?$", "shadow", "window_fallback"),
    Rule("question_003", 1, "question", "phrase", "who actually owns"),
    Rule("advice_mined_093534", 1, "advice", "regex", r"(?i)\bmuch\s+as\s+you\s+can\b", "shadow"),
    Rule("advice_mined_4c9c88", 1, "advice", "regex", r"(?i)\bmake\s+sure\s+you\b"),
    Rule("advice_mined_956e3d", 1, "advice", "regex", r"(?i)\bstart\s+with\s+a\b", "shadow"),
    Rule("advice_mined_8aca4c", 1, "advice", "regex", r"(?i)\bfind\s+a\b", "shadow"),
    Rule("advice_mined_c1c88d", 1, "advice", "regex", r"(?i)\byour\s+organization\b", "shadow"),
    Rule("advice_mined_ecaa06", 1, "advice", "regex", r"(?i)\bwhat\s+you\s+want\b", "shadow"),
    Rule("predictions_mined_3681ea", 1, "predictions", "regex", r"(?i)\bgoing\s+to\s+see\b", "shadow"),
    Rule("predictions_mined_f96c21", 1, "predictions", "regex", r"(?i)\bgoing\s+to\s+be\s+a\b", "shadow"),
    Rule("predictions_mined_84492c", 1, "predictions", "regex", r"(?i)\bi\s+think\s+it'?s\s+going\b", "shadow"),
)

# The shipped seed terms.
TERMS = (
    Term("foundation model", "technology"),
    Term("inference cost", "economics"),
    Term("fine-tuning", "technology"),
    Term("RAG", "technology"),
    Term("AI agent", "technology"),
    Term("agentic", "technology"),
    Term("vertical AI", "market-structure"),
    Term("AI wrapper", "market-structure"),
    Term("moat", "market-structure"),
    Term("commoditization", "market-structure"),
    Term("evals", "methodology"),
    Term("hallucination", "risk"),
    Term("open source", "market-structure"),
    Term("AI governance", "policy"),
    Term("unit economics", "economics"),
    Term("context window", "technology"),
    Term("benchmark", "methodology"),
    Term("product-market fit", "market-structure"),
    Term("distribution", "market-structure"),
    Term("incumbent", "market-structure"),
    Term("open weights", "market-structure"),
)

# The shipped discourse markers.
MARKERS = (
    Marker("but", "contrast", 'discourse-transition filler ("but anyway"); intra-clause contrast with no claim', "1.0.0"),
    Marker("however", "contrast", 'rarely a false positive; watch for "however small" (adverbial not discourse)', "1.0.0"),
    Marker("not X but Y", "contrast", 'pattern not literal; fires on "not … but" sequence; check span for genuine reframe', "1.0.0"),
    Marker("although", "contrast", "subordinating; may introduce weak concession rather than genuine reframe", "1.0.0"),
    Marker("yet", "contrast", 'temporal "yet" (e.g. "has not yet") is a false positive; check for discourse-contrast use', "1.0.0"),
    Marker("on the other hand", "contrast", "almost always discourse contrast; low FP rate", "1.0.0"),
    Marker("instead", "contrast", 'directional replacement ("instead of X do Y") vs discourse pivot; check context', "1.0.0"),
    Marker("should", "deontic", "reported/quoted obligation common in interview transcripts; check speaker role", "1.0.0"),
    Marker("must", "deontic", "reported speech or quoted requirement is a false positive; confirm speaker is advising", "1.0.0"),
    Marker("need to", "deontic", 'conversational filler ("you just need to") may lack genuine prescriptive force', "1.0.0"),
    Marker("have to", "deontic", "colloquial obligation; reported/quoted usage is a false positive", "1.0.0"),
    Marker("ought to", "deontic", "rare in transcripts; low FP when present", "1.0.0"),
    Marker("might", "hedging", 'social politeness ("I might say") vs genuine epistemic hedge; check proposition strength', "1.0.0"),
    Marker("may", "hedging", 'permission sense ("you may go") is a false positive; target epistemic uncertainty only', "1.0.0"),
    Marker("I think", "hedging", "deference hedge vs genuine epistemic uncertainty; extremely common in spoken language", "1.0.0"),
    Marker("I believe", "hedging", 'similar to "I think"; check whether proposition is hedged or asserted confidently', "1.0.0"),
    Marker("perhaps", "hedging", "low FP; almost always epistemic", "1.0.0"),
    Marker("probably", "hedging", 'low FP; watch for "probably the best" (superlative minimiser not hedge)', "1.0.0"),
    Marker("seems", "hedging", 'perceptual/epistemic hedge; the bigram "seems like" missed "it seems" and "seems to be"; watch for "seems like a good idea" (social softener)', "1.0.0"),
    Marker("could", "hedging", 'ability sense ("you could do X") is borderline; target uncertainty/possibility reading', "1.0.0"),
)

# Phrases that depend on something seen or pointed at.
DEICTICS = (
    Deictic("as you can see", "visual_reference"),
    Deictic("as we can see", "visual_reference"),
    Deictic("look at this", "deictic_gesture"),
    Deictic("look at that", "deictic_gesture"),
    Deictic("look at these", "deictic_gesture"),
    Deictic("look at those", "deictic_gesture"),
    Deictic("over here", "deictic_gesture"),
    Deictic("over there", "deictic_gesture"),
    Deictic("right here", "deictic_gesture"),
    Deictic("right there", "deictic_gesture"),
    Deictic("this chart", "visual_reference"),
    Deictic("this slide", "visual_reference"),
    Deictic("this graph", "visual_reference"),
    Deictic("this diagram", "visual_reference"),
    Deictic("this figure", "visual_reference"),
    Deictic("this table", "visual_reference"),
    Deictic("this image", "visual_reference"),
    Deictic("this picture", "visual_reference"),
    Deictic("this screenshot", "visual_reference"),
    Deictic("that chart", "visual_reference"),
    Deictic("that slide", "visual_reference"),
    Deictic("that graph", "visual_reference"),
    Deictic("that one", "deictic_pronoun"),
    Deictic("this one", "deictic_pronoun"),
    Deictic("these ones", "deictic_pronoun"),
    Deictic("those ones", "deictic_pronoun"),
    Deictic("up here", "deictic_gesture"),
    Deictic("down here", "deictic_gesture"),
    Deictic("on the left", "visual_reference"),
    Deictic("on the right", "visual_reference"),
    Deictic("in the middle", "visual_reference"),
)

# Words that lexical density does not count.
FEATURE_STOPWORDS = """
a an the is are was were be been being have has had do does did will would could should may might shall can to of in for on with at by
from as into through during before after above below between each few more most other some such no nor not only own same so than too
very just and but or if it its that this these those i you he she we they what which who whom there here when where why how all both
any about up out then also s t re ve ll d m
""".split()

# Words that the dictionary does not count.
DICTIONARY_STOPWORDS = """
a an the and or but if then else when while of to in on at by for with from into over under
again further is am are was were be been being have has had do does did doing will would shall
should can could may might must this that these those i you he she it we they me him her us them
my your his its our their mine yours hers ours theirs as so than too very just also only not no
nor about above below up down out off here there all any both each few more most other some such
what which who whom whose how why where because between through during before after their there's
i'm you're we're they're it's that's don't doesn't didn't can't won't i've you've we've gonna
wanna kind sort like really actually basically literally okay yeah yes know think going get got
one two three lot lots thing things stuff way ways going go went said say says saying right
mean means well much many being able re ve ll let lets us oh hey um uh
""".split()

# Tuning of the dictionary for its first corpus; replace them for another one.
GENERIC_PHRASES = (
    "little bit", "make sure", "making sure", "years ago", "et cetera", "every single", "long time", "same time", "every day",
    "totally agree", "couple of months", "first time", "feel like", "talk about", "talk little", "talk little bit", "great question",
    "makes sense", "come back", "want to make", "want to talk", "trying to figure", "what's happening", "even though", "we'll see",
    "tech week", "new york", "new york tech", "york tech", "new york tech week", "los angeles", "last question", "next question",
    "good question", "round of applause", "raise your hand", "super excited", "super important", "let's talk", "company called",
    "company names", "quite bit", "want to build", "build something", "trying to build", "building ai", "company names and",
    "silicon valley", "york tech week", "boston tech", "boston tech week", "startup boston", "boston area", "san francisco",
)
LEMMAS = {
    "startups": "startup", "startup's": "startup", "workflows": "workflow", "llms": "llm", "chatbots": "chatbot", "mcps": "mcp",
    "iterating": "iterate", "onboarded": "onboarding", "explainable": "explainability", "dashboarding": "dashboards",
    "bootstrapping": "bootstrapped", "openai's": "openai", "nvidia's": "nvidia", "ai's": "ai",
}
TERM_STOP = ("cetera", "panelists", "quote-unquote", "croasis", "openclaw", "oftentimes")
BLIND_SPOTS = (
    ("RAG", ("rag",), "homograph"),
    ("seed (round)", ("seed",), "homograph"),
    ("prompt", ("prompt",), "homograph"),
    ("fine-tuning", ("fine-tuning", "tuning"), "tokenization"),
    ("product-market fit / PMF", ("pmf", "product-market"), "tokenization"),
    ("open-source", ("open-source",), "tokenization"),
    ("context window", ("context window",), "tokenization"),
    ("Claude (heard as 'cloud')", ("claude", "cloud"), "asr"),
    ("Llama (heard as 'lama')", ("llama", "lama"), "asr"),
)
BOILERPLATE = "speaker names and company names"

# What the score of a usage example looks for.
EXPLAIN_CUES = (
    " is ", " are ", " means ", " refers ", " because ", " so that ", " which ", " where ", " when you ", " lets you ", " allows ", " helps ",
)
FILLER_OPEN_STRONG = (
    "i think", "i mean", "i guess", "you know", "one last thing", "i know i", "to be honest", "honestly", "basically", "like,", "well,",
    "yeah", "okay", "um", "uh", "i would say", "i'd say", "the thing is",
)
FILLER_OPEN_MILD = ("so ", "so,", "and ", "and so", "and then", "but ", "but,", "now,", "actually", "right,", "look,", "i mean,")
FILLER_INLINE = (" like ", "you know", "kind of", "sort of", " i mean", " um ", " uh ", "right?", "i think", " gonna ", " wanna ")
ANNOUNCE_CUES = (
    "hosting", "rsvp", "join us", "register", "panel on", "fireside", "tuesday", "monday", "wednesday", "thursday", "friday", "saturday",
    "sunday", "may the", "june the", "at the seaport", "doors open", "happy hour", "meetup",
)
SELFID_CUES = (
    "my name is", "founder and ceo", "founder and cto", "co-founder and", "cofounder and", "is the founder", "is the ceo",
    "is the co-founder", "is the cto", "welcome to the stage", "please welcome", " ceo of ", " founder of ", " co-founder of ",
    "i'm the ceo", "i'm the founder", "i am the founder", "i am the ceo",
)
DATE_PATTERN = r"\b\d{1,2}(st|nd|rd|th)\b|\b\d{1,2}:\d{2}\b|\bpm\b|\bam\b"
