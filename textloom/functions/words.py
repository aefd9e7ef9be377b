"""Stop lists."""

# Russian and German stop words of the summariser.
SUMMARY_STOP_WORDS = (
    "в", "и", "на", "с", "по", "из", "за", "от", "для", "как", "то", "о",
    "до", "это", "та", "у", "а", "или", "еще", "уже", "их", "ему", "ее", "ей",
    "он", "она", "они", "мы", "вы", "тот", "также", "этот", "эти",
    "bei", "mit", "auf", "von", "zu", "für", "aus", "ist", "im", "als", "des",
    "die", "der", "den", "und", "das", "er", "sie", "wir", "es", "du", "ein",
)

# The English stop list of the public NLTK corpora. Entries with an
# apostrophe are left out, since only wholly alphanumeric tokens meet this list.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn
    hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# The Russian stop list of the public NLTK corpora.
RUSSIAN_STOP_WORDS = tuple(
    """
    и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только
    ее мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни
    быть был него до вас нибудь опять уж вам ведь там потом себя ничего ей может они тут где
    есть надо ней для мы тебя их чем была сам чтоб без будто чего раз тоже себе под будет ж
    тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы
    нее сейчас были куда зачем всех никогда можно при наконец два об другой хоть после над
    больше тот через эти нас про всего них какая много разве три эту моя впрочем хорошо свою
    этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю между
    """.split()
)
