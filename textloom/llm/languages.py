"""Language profiles: scripts, and the function words of languages with the most frequent ones first.

``HEADS`` lists each language's ten most frequent function words in the order of their frequency; ``OTHERS`` further ones. In
Korean they are endings of words. Chinese, Japanese and Thai have no spaces between words: there they are sought in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_right

SCRIPTS = ("latin", "cyrillic", "greek", "arabic", "hebrew", "devanagari", "hangul", "east", "thai", "unlisted")
#: First code points of ranges, and the script from there on (-1: none of its own, as digits and signs).
_RANGES = (
    (0x41, 0), (0x5B, -1), (0x61, 0), (0x7B, -1), (0xAA, 0), (0xAB, -1), (0xB5, 0), (0xB6, -1), (0xBA, 0), (0xBB, -1), (0xC0, 0), (0x2B0, -1), (0x370, 2), (0x400, 1), (0x530, 9),
    (0x590, 4), (0x600, 3), (0x780, 9), (0x8A0, 3), (0x900, 5), (0x980, 9), (0xE00, 8), (0xE80, 9), (0x1100, 6), (0x1200, 9), (0x1C80, 1), (0x1C90, 9), (0x1E00, 0), (0x1F00, 2), (0x2000, -1),
    (0x2C00, 9), (0x2E00, -1), (0x3040, 7), (0x3130, 6), (0x3190, 7), (0xA000, 9), (0xAC00, 6), (0xD800, -1), (0xF900, 7), (0xFB00, 0), (0xFB1D, 4), (0xFB50, 3), (0xFE00, -1),
    (0xFE70, 3), (0xFEFF, -1), (0xFF21, 0), (0xFF3B, -1), (0xFF41, 0), (0xFF5B, -1), (0xFF66, 7), (0xFFA0, 6), (0xFFE0, -1), (0x10000, 9), (0x1F000, -1), (0x20000, 7),
)
_FIRST, _SCRIPT = [a for a, _ in _RANGES], [s for _, s in _RANGES]


def script(word: str) -> int:
    """The script of a word's first letter; -1 without one."""
    for c in word:
        at = bisect_right(_FIRST, ord(c)) - 1
        if at >= 0 and _SCRIPT[at] >= 0:
            return _SCRIPT[at]
    return -1


#: language: (script, share of function words in prose, most frequent function words)
HEADS = {
    "en": ("latin", 0.42, "the of and to in a is that for it"),
    "de": ("latin", 0.42, "die der und in den das von zu mit nicht"),
    "fr": ("latin", 0.42, "de la le et les des en un du une"),
    "es": ("latin", 0.42, "de la que el en y los se del las"),
    "it": ("latin", 0.40, "di e che la il un a per in una"),
    "pt": ("latin", 0.42, "de a o que e do da em um para"),
    "nl": ("latin", 0.42, "de van het een en in is dat op te"),
    "sv": ("latin", 0.40, "och i att det som en på är av för"),
    "da": ("latin", 0.40, "og i at det er en til af på for"),
    "no": ("latin", 0.40, "og i det er på til en som å av"),
    "fi": ("latin", 0.20, "ja on ei se että oli hän joka mutta ovat"),
    "hu": ("latin", 0.32, "a az és hogy nem is egy meg de volt"),
    "cs": ("latin", 0.30, "a se na v je že s z do i"),
    "pl": ("latin", 0.30, "w i na się z nie do to że jest"),
    "ro": ("latin", 0.38, "de și în a la cu pe o din care"),
    "tr": ("latin", 0.18, "ve bir bu da de için çok ile gibi daha"),
    "vi": ("latin", 0.34, "và của là có một được cho trong không những"),
    "id": ("latin", 0.32, "yang dan di untuk dengan dari ini itu pada tidak"),
    "ru": ("cyrillic", 0.30, "и в не на что с он как по это"),
    "uk": ("cyrillic", 0.30, "і в не на що з до у та як"),
    "bg": ("cyrillic", 0.36, "на и да се в от за с не е"),
    "el": ("greek", 0.40, "και το να του η της με που την από"),
    "ar": ("arabic", 0.26, "في من على إلى أن عن هذا التي مع كان"),
    "fa": ("arabic", 0.34, "و در به از که این را با است برای"),
    "he": ("hebrew", 0.22, "של את על לא הוא עם זה היא כי גם"),
    "hi": ("devanagari", 0.40, "के में की है और से का को एक पर"),
    "ko": ("hangul", 0.55, "다 는 을 이 에 의 를 은 가 고"),
    "zh": ("east", 0.22, "的 了 在 是 和 一 不 有 我 这"),
    "ja": ("east", 0.38, "の に は を た が で と て も"),
    "th": ("thai", 0.30, "ที่ และ ใน การ เป็น ของ ได้ ไม่ ให้ มี"),
}
#: Further function words.
OTHERS = {
    "en": "an or but nor so yet if on at by from with without into onto over under about after before between during "
    "through near against behind until since while because as than this these those there here its he him his she her they them their "
    "we us our you your i me my who whom whose which what when where why how are was were be been being am do does did done has have had "
    "having can could will would shall should may might must not no never only also too very just even still once twice then again both each "
    "every some any few many most more other another one all such neither either though although rather within upon out up down off ago per "
    "soon later often almost perhaps anyone nobody anything nothing everyone someone everything two first last next own same let",
    "de": "dem des ein eine einen einem einer eines oder aber doch wenn als wie dass daß ob weil obwohl da so im an am auf "
    "aus bei nach vom zum zur für über unter vor hinter neben zwischen durch gegen ohne um bis seit während wegen ich du er sie es "
    "wir ihr mich dich sich uns euch mir dir ihm ihn ihnen mein dein sein unser euer ihre seine ist sind war waren bin bist wird wurde werden "
    "wurden worden hat habe haben hatte hatten kann können muss müssen soll sollte will wollen kein keine nur auch noch schon sehr mehr "
    "man was wer wo hier dort dann ganz jeden jede jeder jedes alle angeblich",
    "fr": "d l ou mais donc or ni car si que qui quoi dont où quand comme lorsque puisque à au aux dans sur sous "
    "par pour avec sans chez entre vers depuis pendant avant après près je tu il elle on nous vous ils elles me te se lui leur y ce cet cette "
    "ces mon ton son ma ta sa mes tes ses notre votre nos vos leurs est sont était étaient été être a ont avait avaient avoir fut ne pas plus "
    "jamais rien tout tous toute toutes très aussi encore déjà même autre selon dit fait peut doit chaque ainsi",
    "es": "un una unos unas lo al e o u pero sino ni si quien quienes cual donde cuando como porque aunque mientras a "
    "ante bajo con contra desde entre hacia hasta para por según sin sobre tras cerca yo tú él ella ellos ellas nosotros me te nos le les "
    "mi tu su sus mis este esta estos estas ese esa eso es son era eran fue fueron ser está están estaba estaban ha han había hay no ya muy más "
    "menos también tampoco nunca todo todos toda todas otra otro otras otros cada hace qué dice va",
    "it": "lo i gli le uno del dello della dei degli delle al allo alla ai agli alle da dal dalla nel nella nei nelle su sul "
    "sulla con tra fra ed o ma se chi cui dove quando come perché io tu lui lei noi voi loro mi ti si ci vi non più anche ancora già "
    "molto questo questa questi queste quello quella è sono era erano essere ha hanno aveva stato stata ogni suo sua",
    "pt": "os as uma dos das no na nos nas por pelo pela com sem sob sobre entre até desde ou mas se quem onde "
    "quando como porque embora eu tu ele ela nós eles elas me te lhe meu seu sua este esta esse essa isso é são era eram foi foram ser está "
    "estava tem tinha não mais muito também já nunca todo toda todos cada outro outra",
    "nl": "of maar want als die dit deze wie wat waar wanneer hoe omdat terwijl aan bij met voor naar uit over onder "
    "tussen door tegen zonder tot sinds ik je jij hij zij ze wij we jullie u mij hem haar ons hun mijn zijn was waren ben wordt werd worden "
    "heeft had hebben kan kon moet niet geen ook nog al zeer meer er om",
    "sv": "den de med till från om vid under över mellan efter utan var har hade inte men eller när han hon vi ni du jag sig sin sitt så kan ska blev blir ett",
    "da": "et den de med som fra om ved under over mellem efter uden var har havde ikke men eller når han hun vi du jeg sig sin så kan skal blev bliver også",
    "no": "et den de med fra om ved under over mellom etter uten var har hadde ikke men eller når han hun vi du jeg seg sin så kan skal ble blir også for at",
    "fi": "kun niin kuin jos myös vain tai sekä sen sitä hänen he minä sinä me te olen olla olivat ole mikä joka jotka jossa siitä tämä tämän nyt vielä jo koska",
    "hu": "ez azt ezt ha vagy mint már csak még ki mi én te ő mert majd után alatt között szerint nagyon lesz van vannak voltak minden aki ami amely amikor",
    "cs": "v k o u ve za po od pro při jako ale by tak to ten ta si jsem jsou byl byla bylo byli není který která které když nebo už také jen jeho její",
    "pl": "o jak ale po od za przez dla przy co tak był była było są być ma jego jej ich który która które już tylko oraz lub gdy pod nad bez ze",
    "ro": "un al ale lui nu mai că este sunt era au fost fi pentru prin sau dar ca acest această el ea ei lor său după când foarte cel cea până",
    "tr": "o ne ki ama sonra kadar olarak olan her şey ben sen biz siz onlar mi mı değil var yok en ya veya hem bütün oldu olduğu diye göre",
    "vi": "với các này đã người khi để từ đến như cũng ra vào rất nhiều tôi anh chị họ chúng nhưng nếu thì mà lại còn về trên dưới sau đó sẽ đang bị",
    "id": "ke oleh adalah akan juga sudah telah dalam saya kami kita mereka dia ada atau tetapi karena jika saat lebih sangat bisa dapat para sebuah seorang bahwa hanya",
    "ru": "а но из у к за от о же для так его её их она они мы вы я то бы был была были было быть есть если или когда где уже еще ещё только при до после который которая которые над под без",
    "uk": "а але із за від про для так його її їх вона вони ми ви я це той був була були було бути є якщо або коли де вже ще тільки при після який яка які над під без й",
    "bg": "а но като по до от при към със във че ще са беше бяха има няма той тя те ние вие аз това този тази които който която или когато само още вече",
    "el": "τα τη τους τις των στο στη στην στον για δεν θα είναι ήταν ο οι ένα μια ένας αλλά ή όταν αν πως ότι μας σας του μου αυτό αυτή μετά πριν πολύ",
    "ar": "هذه الذي لا ما هو هي بعد قبل كل بين ثم قد لم لن إن أو حتى عند منذ كانت ذلك تلك حيث كما غير هناك أي خلال لكن وقد وهو وهي ولا ومن وفي إذا نحن هم أنا",
    "fa": "آن یک تا بر هم نیز اما یا هر اگر بود شد می ها شده است بودند کرد کرده آنها او ما من شما پس پیش هیچ چون ولی خود دیگر همه بین",
    "he": "אני אתה אנחנו הם היה הייתה היו יש אין אם או אבל רק כל מה מי אל בין אחרי לפני עד כמו יותר מאוד שלו שלה אותו אותה כאשר לאחר",
    "hi": "ने यह वह भी तो ही नहीं हैं था थे थी कि जो इस उस लिए साथ बाद तक या लेकिन अपने कर किया करने गया हो होता जब तब उन्हें कुछ हम मैं वे बहुत",
    "ko": "도 로 서 지 면 며 와 과 한 게 요 만 들 며",
    "zh": "他 她 它 们 你 那 也 就 都 要 会 到 说 对 为 与 从 被 把 而 但 以 很 还 上 个 着 过 之 或 于 并 因为 所以 如果 没有 可以 我们 他们",
    "ja": "から まで です ます した して いる ない こと これ それ この その へ や か ね よ し れ ある という ため など より では には とは ました でした ので",
    "th": "ว่า จะ กับ จาก นี้ ก็ แต่ หรือ มา ไป ความ อยู่ คือ โดย เมื่อ แล้ว ซึ่ง ถ้า เพราะ ต้อง ทำ เรา เขา ฉัน มัน นั้น ยัง กว่า มาก ทั้ง",
}
LANGUAGES = list(HEADS)
#: Scripts without letter case, of which one cannot tell names from other words.
CASELESS = {"arabic", "hebrew", "devanagari", "hangul", "east", "thai", "unlisted"}
HEAD = 10


def _slots() -> dict[str, list[tuple[int, int]]]:
    """word: (language, place among its most frequent function words; ``HEAD`` for further ones)."""
    out: dict[str, list[tuple[int, int]]] = {}
    for i, lang in enumerate(LANGUAGES):
        head = HEADS[lang][2].split()
        for place, w in enumerate(head):
            out.setdefault(w, []).append((i, place))
        for w in set(OTHERS[lang].split()) - set(head):
            out.setdefault(w, []).append((i, HEAD))
    return out


SLOTS = _slots()
_KO = LANGUAGES.index("ko")
_ENDINGS = {w: s for w, ss in SLOTS.items() for lang, s in ss if lang == _KO}
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff]")
_STOPS = "。，、！？；：…「」『』（）《》“”‘’.,!?;:)("


def function_slots(word: str) -> list[tuple[int, int]]:
    """(language, place) for each language whose function word it is (folded); Korean words count by their ending."""
    found = SLOTS.get(word)
    if found is None and ("'" in word or "’" in word):
        parts = {lang: s for p in re.split("['’]", word) for lang, s in SLOTS.get(p, ())}
        return list(parts.items())
    if found is None and "가" <= word[-1:] <= "힣" and len(word) > 1 and word[-1] in _ENDINGS:
        return [(_KO, _ENDINGS[word[-1]])]
    return found or []


def _pattern() -> re.Pattern:
    words = sorted({w for w, ss in SLOTS.items() for lang, _ in ss if HEADS[LANGUAGES[lang]][0] in ("east", "thai")}, key=len, reverse=True)
    function = "|".join(map(re.escape, words))
    stops = f"[{re.escape(_STOPS)}]*"
    free = rf"(?!{function})"
    # function words, pieces of two ideographs or kana, of four letters of other unspaced scripts, and whatever else stands between
    east, letters = "[぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff]", "[฀-໿က-႟ក-៿]"
    other = f"[^{east[1:-1]}{letters[1:-1]}{re.escape(_STOPS)}]+"
    return re.compile(f"(?:{function}|{east}(?:{free}{east})?|{letters}(?:{free}{letters}){{0,3}}|{other}){stops}|[{re.escape(_STOPS)}]+")


_PIECES = _pattern()


def tokens(piece: str) -> list[str]:
    """The tokens of a piece between white space: the piece itself but in scripts that do not part words."""
    return [piece] if piece.isascii() or not _UNSPACED.search(piece) else _PIECES.findall(piece)
