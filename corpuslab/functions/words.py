"""Fixed word lists.

Fixed values: the list must equal the published English stop-word list for
counts and vocabularies to agree.
"""

from __future__ import annotations

ENGLISH_STOP_WORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your
    yours yourself yourselves he him his himself she she's her hers herself it
    it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after
    above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don
    don't should should've now d ll m o re ve y ain aren aren't couldn couldn't
    didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't
    ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Placeholder put in place of words that hold non-ASCII characters; it is
# treated as one more stop word downstream.
MASK_WORD = "qwerty"

# Published irregular forms (form lemma) that no suffix rule gives.
IRREGULAR_NOUNS = dict(
    pair.split()
    for pair in """
    mice mouse, lice louse, feet foot, teeth tooth, geese goose, children child, oxen ox, people people,
    brethren brother, dice die, criteria criterion, phenomena phenomenon, data datum, media medium, strata stratum,
    bacteria bacterium, curricula curriculum, memoranda memorandum, errata erratum, indices index, matrices matrix,
    vertices vertex, vortices vortex, appendices appendix, analyses analysis, theses thesis, crises crisis,
    hypotheses hypothesis, oases oasis, axes axis, bases basis, diagnoses diagnosis, parentheses parenthesis,
    cacti cactus, fungi fungus, nuclei nucleus, radii radius, stimuli stimulus, alumni alumnus, syllabi syllabus,
    foci focus, larvae larva, antennae antenna, formulae formula, genera genus, corpora corpus, wives wife,
    knives knife, lives life, selves self
    """.split(",")
)
IRREGULAR_VERBS = dict(
    pair.split()
    for pair in """
    am be, is be, are be, was be, were be, been be, had have, has have, did do, done do, does do, went go, gone go,
    goes go, said say, made make, took take, taken take, came come, saw see, seen see, knew know, known know, got get,
    gotten get, gave give, given give, found find, thought think, told tell, became become, left leave, felt feel,
    brought bring, began begin, begun begin, kept keep, held hold, wrote write, written write, stood stand, heard hear,
    meant mean, met meet, ran run, paid pay, sat sit, spoke speak, spoken speak, led lead, grew grow, grown grow,
    lost lose, fell fall, fallen fall, sent send, built build, understood understand, drew draw, drawn draw,
    broke break, broken break, spent spend, rose rise, risen rise, drove drive, driven drive, bought buy, wore wear,
    worn wear, chose choose, chosen choose, ate eat, eaten eat, flew fly, flown fly, forgot forget, forgotten forget,
    hid hide, hidden hide, rode ride, ridden ride, sang sing, sung sing, slept sleep, stole steal, stolen steal,
    swam swim, swum swim, taught teach, threw throw, thrown throw, woke wake, won win, caught catch, fought fight,
    sold sell, sought seek, shook shake, shaken shake, tied tie, lay lie, lain lie
    """.split(",")
)

# Suffix detachment rules (suffix, replacement) in rule order.
NOUN_RULES: tuple[tuple[str, str], ...] = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)
VERB_RULES: tuple[tuple[str, str], ...] = (
    ("s", ""), ("ies", "y"), ("es", "e"), ("es", ""),
    ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
)
