from __future__ import annotations

import numpy as np
import pytest

from textloom.llm import languages, prose

PROSE = [
    "The old mill near the river was repaired in spring, and nobody in the village remembers who had paid for it.",
    "THE OLD MILL NEAR THE RIVER WAS REPAIRED IN SPRING, AND NOBODY REMEMBERS WHO HAD PAID FOR IT.",
    "the old mill near the river was repaired in spring and nobody in the village remembers who had paid for it",
    "In 1921 the town held 45 crates, 37 barrels and 430 sacks, up from 800 in 1722, and 12 of the 20 houses were empty.",
    "Wenn die Lampe fehlt, muss Otto bei Anna in der Küche eine alte Kerze holen und nach der Ernte warten.",
    "La vieille maison près de la gare a été vendue hier par les enfants de Paul, mais la cour est restée ouverte.",
    "La casa vieja cerca de la estación fue vendida ayer por los hijos de Pablo, pero el patio sigue abierto.",
    "Vanha mylly joen rannalla korjattiin keväällä, eikä kukaan kylässä muista, kuka siitä oli maksanut.",
    "- bright tile\n- old jar\nThe old mill near the river was repaired in spring, and nobody remembers who had paid for it.",
]
#: The same two sentences in many languages; Swahili, Estonian and Serbian have no list of function words, Tamil, Georgian, Amharic, Burmese and Khmer
#: no listed language in their script.
LANGUAGES = {
    "en": "Yesterday we walked to the old harbour because the weather was fine. The boats had already left, but an old man told us that they would be back before dark.",
    "de": "Gestern gingen wir zum alten Hafen, weil das Wetter schön war. Die Boote waren schon weg, aber ein alter Mann sagte uns, dass sie vor der Dunkelheit zurückkommen würden.",
    "fr": "Hier, nous sommes allés au vieux port parce qu'il faisait beau. Les bateaux étaient déjà partis, mais un vieil homme nous a dit qu'ils reviendraient avant la nuit.",
    "es": "Ayer fuimos al viejo puerto porque hacía buen tiempo. Los barcos ya se habían ido, pero un anciano nos dijo que volverían antes del anochecer.",
    "it": "Ieri siamo andati al vecchio porto perché il tempo era bello. Le barche erano già partite, ma un vecchio ci ha detto che sarebbero tornate prima di notte.",
    "pt": "Ontem fomos ao velho porto porque o tempo estava bom. Os barcos já tinham partido, mas um velho nos disse que voltariam antes de escurecer.",
    "nl": "Gisteren liepen we naar de oude haven omdat het mooi weer was. De boten waren al weg, maar een oude man vertelde ons dat ze voor het donker terug zouden zijn.",
    "sv": "Igår gick vi till den gamla hamnen eftersom vädret var fint. Båtarna hade redan gått, men en gammal man sade att de skulle vara tillbaka före mörkret.",
    "da": "I går gik vi til den gamle havn, fordi vejret var fint. Bådene var allerede sejlet, men en gammel mand sagde, at de ville være tilbage før mørket.",
    "fi": "Eilen kävelimme vanhaan satamaan, koska sää oli kaunis. Veneet olivat jo lähteneet, mutta vanha mies kertoi meille, että ne palaisivat ennen pimeää.",
    "hu": "Tegnap elsétáltunk a régi kikötőbe, mert szép idő volt. A hajók már elindultak, de egy öreg ember azt mondta, hogy sötétedés előtt visszatérnek.",
    "cs": "Včera jsme šli do starého přístavu, protože bylo hezké počasí. Lodě už odpluly, ale starý muž nám řekl, že se vrátí před setměním.",
    "pl": "Wczoraj poszliśmy do starego portu, bo pogoda była ładna. Łodzie już odpłynęły, ale stary człowiek powiedział nam, że wrócą przed zmrokiem.",
    "ro": "Ieri am mers în vechiul port pentru că vremea era frumoasă. Bărcile plecaseră deja, dar un bătrân ne-a spus că se vor întoarce înainte de lăsarea nopții.",
    "tr": "Dün akşam arkadaşlarımla birlikte yeni açılan lokantaya gittik ve çok güzel yemekler yedik. Sonra deniz kıyısında uzun bir yürüyüş yaptık ama hava biraz soğuktu.",
    "vi": "Hôm qua chúng tôi đi bộ đến bến cảng cũ vì thời tiết rất đẹp. Những chiếc thuyền đã rời đi, nhưng một ông già nói với chúng tôi rằng họ sẽ trở lại trước khi trời tối.",
    "id": "Kemarin kami berjalan ke pelabuhan tua karena cuacanya bagus. Perahu-perahu sudah berangkat, tetapi seorang lelaki tua mengatakan bahwa mereka akan kembali sebelum gelap.",
    "sw": "Jana tulitembea hadi bandari ya zamani kwa sababu hali ya hewa ilikuwa nzuri. Mashua zilikuwa zimeondoka, lakini mzee mmoja alituambia kwamba zingerudi kabla ya giza.",
    "et": "Eile jalutasime vanasse sadamasse, sest ilm oli ilus. Paadid olid juba lahkunud, kuid üks vana mees ütles meile, et need tulevad tagasi enne pimedat.",
    "ru": "Вчера мы пошли в старый порт, потому что погода была хорошая. Лодки уже ушли, но один старик сказал нам, что они вернутся до темноты.",
    "uk": "Вчора ми пішли до старого порту, бо погода була гарна. Човни вже відпливли, але старий чоловік сказав нам, що вони повернуться до темряви.",
    "bg": "Вчера отидохме до старото пристанище, защото времето беше хубаво. Лодките вече бяха тръгнали, но един старец ни каза, че ще се върнат преди да се стъмни.",
    "sr": "Јуче смо отишли у стару луку јер је време било лепо. Чамци су већ отишли, али нам је један старац рекао да ће се вратити пре мрака.",
    "el": "Χθες πήγαμε στο παλιό λιμάνι γιατί ο καιρός ήταν καλός. Οι βάρκες είχαν ήδη φύγει, αλλά ένας γέρος μας είπε ότι θα γυρίσουν πριν νυχτώσει.",
    "ar": "ذهبنا أمس إلى الميناء القديم لأن الطقس كان جميلا. كانت القوارب قد غادرت بالفعل، لكن رجلا عجوزا أخبرنا أنها ستعود قبل حلول الظلام.",
    "fa": "دیروز به بندر قدیمی رفتیم چون هوا خوب بود. قایق‌ها رفته بودند، اما پیرمردی به ما گفت که پیش از تاریکی برمی‌گردند.",
    "he": "אתמול הלכנו אל הנמל הישן כי מזג האוויר היה יפה. הסירות כבר יצאו, אבל איש זקן אמר לנו שהן יחזרו לפני החושך.",
    "hi": "कल हम पुराने बंदरगाह गए क्योंकि मौसम अच्छा था। नावें जा चुकी थीं, लेकिन एक बूढ़े आदमी ने हमें बताया कि वे अंधेरा होने से पहले लौट आएँगी।",
    "ta": "நேற்று வானிலை நன்றாக இருந்ததால் நாங்கள் பழைய துறைமுகத்திற்கு நடந்து சென்றோம். படகுகள் ஏற்கனவே சென்றுவிட்டன, ஆனால் ஒரு முதியவர் இருட்டும் முன் திரும்பும் என்றார்.",
    "ka": "გუშინ ძველ ნავსადგურში წავედით, რადგან კარგი ამინდი იყო. ნავები უკვე წასული იყო, მაგრამ ერთმა მოხუცმა გვითხრა, რომ დაბნელებამდე დაბრუნდებოდნენ.",
    "am": "ትናንት አየሩ ጥሩ ስለነበር ወደ አሮጌው ወደብ ሄድን። ጀልባዎቹ ቀድሞውኑ ሄደው ነበር፤ ነገር ግን አንድ ሽማግሌ ከመጨለሙ በፊት እንደሚመለሱ ነገሩን።",
    "ko": "어제 우리는 날씨가 좋아서 오래된 항구까지 걸어갔다. 배들은 이미 떠났지만 한 노인이 어두워지기 전에 돌아올 것이라고 말해 주었다.",
    "zh": "昨天天气很好，我们走到了老港口。船已经开走了，但是一位老人告诉我们，天黑之前它们会回来的。我们在岸边坐了很久，看着海面上的灯光。",
    "zh2": "昨天天气很好我们走到了老港口船已经开走了但是一位老人告诉我们天黑之前它们会回来的",
    "ja": "昨日は天気が良かったので、私たちは古い港まで歩いて行きました。船はもう出てしまっていましたが、老人が暗くなる前に戻ってくると教えてくれました。",
    "th": "เมื่อวานนี้อากาศดีมาก เราจึงเดินไปที่ท่าเรือเก่า เรือออกไปแล้ว แต่ชายชราคนหนึ่งบอกเราว่าเรือจะกลับมาก่อนมืด",
    "my": "မနေ့က ရာသီဥတုကောင်းလို့ ကျွန်တော်တို့ ဆိပ်ကမ်းဟောင်းကို လမ်းလျှောက်သွားခဲ့တယ်။ လှေတွေက ထွက်သွားပြီးသားဖြစ်ပေမယ့် အဘိုးကြီးတစ်ယောက်က ပြန်လာမယ်လို့ ပြောတယ်။",
    "km": "ម្សិលមិញ យើងបានដើរទៅកំពង់ផែចាស់ ព្រោះអាកាសធាតុល្អ។ ទូកបានចេញទៅហើយ ប៉ុន្តែបុរសចំណាស់ម្នាក់បានប្រាប់យើងថា ពួកគេនឹងត្រឡប់មកវិញមុនងងឹត។",
    "long": "Der Donaudampfschifffahrtsgesellschaftskapitän und die Rindfleischetikettierungsüberwachungsaufgabe waren im Gespräch.",
}
UNLISTED = {"sw", "et", "sr", "ta", "ka", "am", "my", "km"}
OTHER_SCRIPTS = [
    "苹果 香蕉 橘子 葡萄 西瓜\n桌子 椅子 电脑 书本 铅笔",
    "北京 12 34 56\n上海 22 33 44\n广州 1 2 3",
    "Яблоко / Груша / Стол / Стул / Окно / Дверь / Книга",
    "الاسم: محمد\nالمدينة: القاهرة\nالهاتف: 12345\nالعمر: 33",
    "Имя: Иван\nГород: Москва\nТелефон: 12345",
]
OTHER = [
    "1. red chair Malmo\n2. blue table Turin\n3. green lamp Lyon",
    "Malmo\t12\t4.50\tred\nTurin\t9\t3.20\tblue\nLyon\t44\t1.75\tgreen",
    "Name: Oak table\nOwner: Ann Lee\nBuilt in: 40 pieces",
    "name = oak table; owner = Ann Lee; built = 40 pieces",
    '{"Name": "Oak table", "Owner": "Ann Lee", "Weight": "40 kg"}',
    "2021-12-13 05:00 WARN router.main id=20229\n2021-12-14 06:10 ERROR pump.aux id=104",
    "sX6Egb8M4MRZmRbzcB8RAfIydxO0wXXJ0Wje0YSt+m8629olHLK7O7cpNTo3OB7R",
    "gdueb utrbfled jjg lvwddz tnlctsc lxufbev wwx vvpb qtvhowubafj shy crstmkhbjc jkjxuexqpa",
    "calm bearing buffered signpost adopt coupon parse miller quilt wooden oval cached nested router",
    "Oak chair .......... 12.40\nElm table .......... from 99.00",
    "Home > Garden > Tools > Spades > Steel",
]


@pytest.mark.parametrize("text", PROSE)
def test_prose(text):
    assert prose.Judge()([text])["prose_share"][0] >= 0.5


@pytest.mark.parametrize("code", LANGUAGES)
def test_prose_of_many_languages(code):
    text = LANGUAGES[code]
    whole = prose.Judge()([text, text.upper(), text.replace(" ", "  ")])
    assert (whole["prose_share"] >= 0.5).all()
    if code not in UNLISTED and len(code) == 2:
        assert languages.LANGUAGES[whole["language"][0]] == code


def test_languages_of_one_text():
    """Each line by its own language and script."""
    text = "\n".join(LANGUAGES[c] for c in ("en", "ru", "zh", "th", "ar", "ko", "ta", "de"))
    assert prose.Judge()([text])["prose_share"][0] == 1.0


def test_tokens_of_unspaced_scripts():
    assert languages.tokens("我们去了市场，买了菜。") == ["我们", "去", "了", "市场，", "买", "了", "菜。"]
    assert languages.tokens("plain") == ["plain"] and "".join(languages.tokens("ab我们cd-12。x")) == "ab我们cd-12。x"
    assert languages.script("123") == -1 and languages.script("été") == 0 and languages.script("ж") == 1


@pytest.mark.parametrize("text", OTHER + OTHER_SCRIPTS)
def test_other(text):
    assert prose.Judge()([text])["prose_share"][0] < 0.5


def test_divergence():
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    d = prose._divergence(p, p)
    assert np.allclose(np.diag(d), 0) and np.isclose(d[0, 1], d[1, 0]) and np.isclose(prose._divergence(np.array([[1.0, 0]]), np.array([[0.0, 1]]))[0, 0], 1)


def test_profiles_are_distributions():
    assert np.allclose(prose._TOKEN_P.sum(1), 1, atol=0.02) and np.allclose(prose._END_P.sum(1), 1, atol=0.02)
    assert np.allclose(prose._CHAR_P.sum(1), 1, atol=0.02)
    for q in (prose._TOKEN_Q, prose._CHAR_Q, prose._FUNCTION_Q):
        assert np.allclose(q.sum(2), 1, atol=0.02) and (q >= 0).all()


def test_nulls_blanks_long_texts_and_forgetting(spark):
    rows = [(1, None), (2, " \n "), (3, PROSE[0] + "\n" + OTHER[0]), (4, OTHER[1] * 3000), (3, PROSE[0])]
    got = prose.judged(spark.createDataFrame(rows, "row long, text string").coalesce(1)).collect()
    assert [r["row"] for r in got] == [1, 2, 3, 4, 3]
    assert got[0]["n_lines"] is None and got[0]["prose_share"] is None
    assert got[1]["n_lines"] == 0 and got[1]["prose_share"] is None and got[1]["profile"] is None
    assert got[2]["prose_share"] > 0.5 > got[3]["prose_share"] and got[4]["language"] == "en"
    assert prose.judged(spark.createDataFrame([], "row long, text string")).count() == 0
    assert prose.Judge(most=2)(PROSE)["prose_share"].tolist() == prose.Judge()(PROSE)["prose_share"].tolist()


def test_pages_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(PROSE + OTHER)], "row long, text string").coalesce(1)
    whole = prose.judged(df).collect()
    monkeypatch.setattr(prose, "PAGE", 50)
    assert prose.judged(df).collect() == whole


def test_ratios(spark):
    df = spark.createDataFrame([("ab1 c!",), ("",), (None,), ("  ",)], "text string").select(*(c.alias(k) for k, c in prose.ratios(__import__("pyspark.sql.functions", fromlist=["x"]).col("text")).items()))
    a, b, c, d = (tuple(r) for r in df.collect())
    assert a == (6, 2, 2.5, 0.5, 0.166667, 0.166667)
    assert b == (0, 0, 0.0, 0.0, 0.0, 0.0) and c == (None,) * 6 and d == (2, 0, 0.0, 0.0, 0.0, 0.0)
