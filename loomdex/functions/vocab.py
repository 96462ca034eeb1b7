"""Word lists and phrases. The search stop words are a parameter; these are the defaults."""

# Analyzer stop list (published Russian Snowball list).
RUSSIAN_STOP = """
и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне было вот от меня
еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам сказал
ведь там потом себя ничего ей может они тут где есть надо ней для мы тебя их чем была сам чтоб без будто человек
чего раз тоже себе под жизнь будет ж тогда кто этот говорил того потому этого какой совсем ним здесь этом один
почти мой тем чтобы нее кажется сейчас были куда зачем сказать всех никогда сегодня можно при наконец два об
другой хоть после над больше тот через эти нас про всего них какая много разве сказала три эту моя впрочем
хорошо свою этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю между
""".split()

# English function words (published Snowball list, without contractions).
ENGLISH_STOP = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now
""".split()

# Default for query cleaning; replace with a loaded list through the `stop` parameters.
QUERY_STOP = sorted(set(RUSSIAN_STOP) | set(ENGLISH_STOP))

# Phrases that mark a boilerplate line.
BOILERPLATE_PHRASES = [
    "медиафайлы на викискладе",
    "материал из википедии",
    "перейти к навигации",
    "перейти к поиску",
    "см. также",
    "навигация",
]

# Boilerplate prefixes, tried in this order.
BOILERPLATE_PREFIXES = [
    "Материал из Википедии",
    "Материал из Вики",
    "Медиафайлы на Викискладе",
    "From Wikipedia",
    "Jump to navigation",
    "Перейти к навигации",
    "Перейти к поиску",
]

# Encyclopedia remnants replaced by a blank, case-insensitive, in this order.
WIKI_PATTERNS = [
    r"\[\s*(править|правка|edit)\s*\|?\s*(код|source|wiki)?\s*\]",
    r"\[\s*\d+\s*\]",
    r"\[\s*править\s*код\s*\]",
    r"\[\s*скрыть\s*\]",
    r"\[\s*показать\s*\]",
    r"Материал из Википедии\s*—\s*свободной энциклопедии",
    r"Текущая версия страницы пока не проверялась опытными участниками[^.]*\.",
    r"Перейти к навигации",
    r"Перейти к поиску",
    r"У этого термина существуют и другие значения[^.]*\.",
    r"Запрос «[^»]*» перенаправляется сюда[^.]*\.",
    r"См\. также[^.]*\.",
    r"Эта статья[^.]*\.",
]

# File extensions that are never pages.
MEDIA_EXTENSIONS = "jpg jpeg png gif svg webp mp4 mp3 pdf zip rar exe css js".split()

# Marks of service pages, matched case-sensitively in the decoded URL.
SERVICE_MARKS = [
    "action=",
    "oldid=",
    "diff=",
    "title=Special:",
    "title=Служебная:",
    "Special:Search",
    "Special:RecentChanges",
    "_(значения)",
    "_(значение)",
    "мои-комментарии",
    "добавить-новую",
    "сообщить-об-ошибке",
    "шпаргалка",
    "правообладателям",
    "/dmca",
    "/license",
    "пользовательское-соглашение",
    "политика-конфиденциальности",
    "github.com",
    "opensource.org",
]

# Words skipped by the keyword-in-context view.
KWIC_STOP = """
в и на с по для как что это из о к у от за до при не же бы или но а то такое такой такая такие который которая
которые the a an and or but in on at to for of with by from as is was what how why when
""".split()

# Endings cut by the light stemmer, first match wins.
LIGHT_ENDINGS = """
ами ями ому ему ого его ать ять ить ов ев ий ый ой ая яя ое ее ие ые ам ям ом ем им ым ах ях их ых а я о е и ы у ю ь
""".split()

# Elements removed from a page before its text is read.
DROPPED_TAGS = ["nav", "header", "footer", "aside"]
DROPPED_CLASSES = ["sidebar", "menu", "reference", "mw-editsection"]
DROPPED_TABLE_CLASS = "infobox"

# Crawl configuration defaults; the agent name is our own.
CONFIG_DEFAULTS = {
    "max_pages": 100,
    "max_depth": 4,
    "delay_ms": 500,
    "parallelism": 5,
    "user_agent": "loomdex/1.0",
}

# Upload limits and placeholder texts.
MAX_UPLOAD_BYTES = 20 * 1024 * 1024
PDF_ERROR_TEXT = "PDF read error"
EMPTY_TITLE = "document"
MIN_PAGE_BYTES = 200
MIN_PARAGRAPH_BYTES = 100

# Progress messages of a crawl.
CRAWL_STARTED = "Краулинг запущен..."
CRAWL_FINISHED = "Краулинг завершён. Проиндексировано: %d страниц."
