"""Fixed values of the content rules, as plain data.

Every value here is part of the observable results (word lists, labels, limits,
codes), so it is stated as text, in natural order.
"""

from __future__ import annotations

# Sources in ingestion order, with tier (None: evidence only), file, and whether their text may ship.
SOURCES = [
    ("ngsl", 1, "ngsl.xlsx", False),
    ("new_dolch", 1, "new_dolch.csv", False),
    ("cefrj", 2, "cefrj.csv", False),
    ("nawl", 3, "ngsl.xlsx", False),
    ("tsl", 3, "tsl.csv", False),
    ("bsl", 3, "bsl.csv", False),
    ("octanove", 3, "octanove.csv", False),
    ("legacy_dist", None, "legacy_core.sqlite", False),
    ("ipa_dict", None, "ipa_dict.txt", True),
]

# Part-of-speech labels of the sources and their canonical forms.
POS_NAMES = {
    "noun": "noun", "verb": "verb", "adjective": "adj", "adverb": "adv", "pronoun": "pron", "preposition": "prep",
    "determiner": "det", "conjunction": "conj", "number": "num", "interjection": "interj", "modal auxiliary": "modal",
    "be-verb": "verb", "do-verb": "verb", "have-verb": "verb", "infinitive-to": "particle", "vern": "verb",
    "adj": "adj", "adv": "adv", "pron": "pron", "prep": "prep", "det": "det", "conj": "conj", "num": "num",
    "interj": "interj", "modal": "modal", "particle": "particle",
}

# Levels from easy to hard.
CEFR_LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2"]

# The rules for headwords.
ONE_LETTER_WORDS = ["a", "i"]
DOTTED_WORDS = ["a.m.", "p.m.", "etc.", "e.g.", "i.e."]
NO_WORDS = ["", "-", "'"]
WORD_PATTERN = "^[a-zÀ-ɏ][a-zÀ-ɏ' \\-.]*$"
MOST_HEADWORD_WORDS = 3

# English words that hardly any English sentence lacks.
ENGLISH_MARKERS = (
    "the a an and or but nor so if as than then that this these those "
    "was were is are am be been being do does did done "
    "has have had will would can could should must may might shall "
    "to of in on with for at by from into onto about after before "
    "between through during without within over under up down out off "
    "i you he she it we they me him her us them "
    "my your his its our their mine yours hers ours theirs "
    "not no yes there here when where what who whom which why how "
    "all any some each every both either neither more most other another "
    "one two first new get got go went make made take took see saw "
    "know knew like want need come came look also just only very "
    "because while although s re ve ll d t m"
).split()

# Fixed values by language: marker letters, marker words, markers shared with English, infinitive endings.
LANGUAGES = {
    "tr": {
        "letters": "çğıöşüÇĞİÖŞÜ",
        "words": "bir ve bu şu için ile olarak daha çok ama gibi kadar sonra önce olan değil yok mi mı degil icin cok".split(),
        "ambiguous": "at an on in her not it".split(),
        "infinitive": ["mek", "mak"],
        "term_match": True,
    },
    "es": {
        "letters": "ñáéíóúü¿¡",
        "words": (
            "el la los las de del que con para pero más muy una uno como cuando donde también esta este esos esas en es "
            "son se su sus al lo le les ni sin sobre hasta desde entre algo alguien ser está están hacer cada todo todos "
            "otro otra puede tener porque aunque siempre nunca ahora persona personas cosa cosas"
        ).split(),
        "ambiguous": "a no me he ve".split(),
        "infinitive": ["ar", "er", "ir", "arse", "erse", "irse"],
        "term_match": False,
    },
    "pt-BR": {
        "letters": "ãõçáéíóúâêô",
        "words": (
            "não com para mas muito uma um como quando onde também está esse essa esses essas isso então de da das dos "
            "que em por ao aos na nas nos seu sua seus suas ser são estão pelo pela sem sobre até ainda cada todo todos "
            "outro outra algo alguém ou mais quem foi era tem pessoa pessoas coisa coisas"
        ).split(),
        "ambiguous": "a as do no me so".split(),
        "infinitive": ["ar", "er", "ir", "or"],
        "term_match": False,
    },
    "de": {
        "letters": "äöüßÄÖÜ",
        "words": (
            "und nicht mit für aber sehr eine ein wie wenn wo auch dieser diese dieses dann oder kein keine der das den "
            "dem des einen einem einer eines ist sind zu auf von im vom zum zur dass als nach bei nur noch sich sein "
            "seine ihr ihre werden wird wurde haben hat hatte kann etwas alle viele jemand menschen"
        ).split(),
        "ambiguous": "in so am an will was her also".split(),
        "infinitive": ["en", "n"],
        "term_match": False,
    },
}

# Turkish endings that a dictionary form doesn't have, and those that a search ignores.
TURKISH_CONJUGATED = "yor muş miş acak ecek malı meli dı di du dü tı ti tu tü".split()
TURKISH_ENDINGS = (
    "larından lerinden larıyla leriyle larında lerinde sının sinin sunun sünün ların lerin larda lerde lardan lerden "
    "ları leri lara lere lar ler ında inde unda ünde nın nin nun nün dan den tan ten yla yle ile da de ta te sı si su "
    "sü ya ye ıyorum iyorum uyorum üyorum ıyoruz iyoruz uyoruz üyoruz ıyorsun iyorsun uyorsun üyorsun ıyor iyor uyor "
    "üyor yor acağını eceğini acağım eceğim acak ecek dığını diğini duğunu düğünü mıştı mişti muştu müştü mış miş muş "
    "müş dım dim dum düm tım tim tum tüm dık dik duk dük dı di du dü tı ti tu tü malı meli arak erek ince ınca unca ünce"
).split()

# Words that no gap question asks for, the parts of speech it asks for, and (word, part) exceptions.
CLOZE_POS = ["noun", "verb", "adj", "adv"]
FUNCTION_WORDS = (
    "about above across after against along alongside among around at before behind below beneath beside besides "
    "between beyond by despite down during except for from in inside into near of off on onto opposite out outside over "
    "past per since through throughout till to toward towards under underneath until up upon versus via with within "
    "without i me my mine myself you your yours yourself yourselves he him his himself she her hers herself it its "
    "itself we us our ours ourselves they them their theirs themselves this that these those here there someone "
    "somebody something anyone anybody anything everyone everybody everything nobody nothing a an the all any both each "
    "either enough every many much neither no none several some such and or but nor so if unless although though while "
    "whereas whether because as than how what when where which who whom whose why be am is are was were been being will "
    "would shall should can could may might must ought not very too quite non anti mid mini o'clock"
).split()
CLOZE_EXCEPTIONS = [("can", "noun"), ("will", "noun"), ("while", "noun")]

# Ranks of model labels (less is better), by label and by prefix; of any other label; of none.
MODEL_RANKS = {
    "gemini:gemini-2.5-pro": 10,
    "gemini:gemini-2.5-flash": 20,
    "cloudflare:@cf/meta/llama-3.3-70b-instruct-fp8-fast": 20,
    "openai:gpt-4o-mini": 20,
    "deepseek:deepseek-chat": 30,
    "cloudflare:@cf/qwen/qwen3-30b-a3b-fp8": 40,
    "local:qwen3:14b": 40,
    "local:qwen3:8b": 50,
    "cloudflare:@cf/meta/llama-3.1-8b-instruct": 50,
}
PREFIX_RANKS = {"gemini:": 20, "openai:": 20, "cloudflare:": 30, "deepseek:": 30, "local:": 50}
DEFAULT_RANK, NO_LABEL_RANK = 90, 0

# Scenes of gap questions.
SCENES = [
    "at home, everyday family life",
    "at work or in an office",
    "travelling: airport, train, hotel",
    "at school or while studying",
    "health: doctor, illness, exercise",
    "shopping and paying for things",
    "food, cooking and eating out",
    "sport and free time",
    "nature, weather and outdoors",
    "technology, phones and computers",
    "money, banking and bills",
    "friends, neighbours and social life",
    "city life: streets, transport, rules",
    "news, work meetings and plans",
]

# Difficulty, least and most words, whether a distractor's level counts.
BANDS = [("kolay", 5, 9, True), ("orta", 9, 15, True), ("zor", 15, 25, False)]
WORD_TOLERANCE, LEVEL_TOLERANCE = 3, 1
QUESTIONS, OPTIONS, OPENING_WORDS = 3, 4, 3
HINT_WORDS, REASON_WORDS = (3, 20), (4, 40)
RULES_PER_SENTENCE, NOTE_CHARS = (1, 3), (8, 240)
BLANK = "____"

# References to an option by its place.
PLACE_PATTERN = (
    r"(?i)\b(?:first|second|third|fourth) option\b|\boption [a-d]\b|\boption (?:one|two|three|four)\b"
    r"|\b(?:1st|2nd|3rd|4th) option\b|\bletter [a-d]\b"
)

# Fields that a person may correct; those that need a language; those that may be null; trust fields that are read but ignored.
EDITABLE = ["gloss_en", "register", "usage_note", "examples", "cloze", "cloze_rationale", "grammar"]
EDITABLE_L1 = ["gloss_l1", "gloss_note_l1", "definition_l1", "usage_note_l1", "examples_l1", "cloze_l1", "cloze_rationale_l1", "grammar_l1"]
NULLABLE = ["register", "usage_note", "usage_note_l1", "gloss_note_l1"]
"""Column families of a person's corrections."""
