"""A labelled table of URLs: hosts and paths to block and to allow, by what words in them mean.

Hosts are made by a rule from pairs of words of one topic. The table knows nothing of the pages that are
judged with it; whoever has labelled URLs of their own gives these instead.
"""

from pyspark.sql import DataFrame, SparkSession

# Words of each topic, and words of paths that go with them.
BLOCKED = {
    "gambling": (
        "casino poker roulette jackpot slots betting blackjack baccarat wager lottery bingo gambling craps",
        "bonus spins deposit odds tables vip",
    ),
    "adult": (
        "porn xxx nude webcam erotic escort hardcore milf hentai fetish amateur sexcam",
        "videos girls live galleries hot tubes",
    ),
    "pills": (
        "viagra cialis pharmacy steroids xanax tramadol levitra ambien valium dietpill",
        "buy noprescription order discount generic cheap",
    ),
    "money": (
        "payday loan forex bitcoin doubler ponzi getrich cashback moneymaker binaryoptions",
        "apply instant earn profit signup guaranteed",
    ),
    "copies": (
        "replica rolex knockoff counterfeit handbag designerfake luxurycopy swisscopy",
        "watches outlet sale wholesale brand shop",
    ),
    "piracy": (
        "warez keygen crack torrent serial nulled cracked leaked rapidshare",
        "download full iso activator patch free",
    ),
    "traps": (
        "phishing malware spyware trojan exploit botnet adware clickbait popunder",
        "login verify update account redirect track",
    ),
}
ALLOWED = {
    "news": (
        "news gazette herald tribune journal daily observer chronicle courier reporter bulletin press",
        "politics world local opinion archive weather",
    ),
    "learning": (
        "university college school library academy lecture campus science physics biology mathematics history",
        "courses research students faculty thesis syllabus",
    ),
    "culture": (
        "museum theatre orchestra gallery opera cinema poetry literature archive heritage painting sculpture",
        "exhibitions tickets programme collection visit season",
    ),
    "home": (
        "kitchen recipes garden cooking baking woodwork knitting furniture gardening cookbook",
        "soups seasons tools patterns tips dinner",
    ),
    "outdoors": (
        "hiking cycling sailing climbing camping mountains running football tennis swimming",
        "routes maps clubs results training events",
    ),
    "health": (
        "hospital clinic nursing dentist medicine health pediatrics wellness therapy vaccination",
        "appointments doctors advice symptoms wards contact",
    ),
    "public": (
        "government council parliament ministry statistics census courts transport railway police",
        "forms services reports timetable laws departments",
    ),
    "computing": (
        "developer software compiler python database kernel documentation manual wiki library",
        "docs reference tutorial release install api",
    ),
    "trade": (
        "bookshop hardware bakery florist bicycles stationery insurance accounting architect printing",
        "products about opening stores delivery catalogue",
    ),
    "nature": (
        "astronomy geology weather oceans forest birds botany climate volcano insects",
        "observations species atlas photos forecast guide",
    ),
}
_ENDS = ("info", "io", "co", "eu", "us", "biz", "tv", "me")
_PREFIXES = ("", "www.", "my", "the", "web.", "top")
_STEPS = (1, 2, 4)  # from a word to those it is paired with


def rows() -> list[tuple[str, str, float]]:
    """Rows (host, url, label); label 1 is to be blocked. Every host has several URLs."""
    out = []
    for label, topics in ((1.0, BLOCKED), (0.0, ALLOWED)):
        for words, paths in topics.values():
            words, paths = words.split(), paths.split()
            for i, word in enumerate(words):
                for k, step in enumerate(_STEPS):
                    other = words[(i + step) % len(words)]
                    joint = ("-", "", ".")[k]
                    host = f"{_PREFIXES[(i + k) % len(_PREFIXES)]}{word}{joint}{other}.{_ENDS[(i + 3 * k) % len(_ENDS)]}"
                    first, second = paths[(i + k) % len(paths)], paths[(i + 2 * k + 1) % len(paths)]
                    out.append((host, f"https://{host}/{first}/{second}", label))
                    out.append((host, f"http://{host}/{second}.htm", label))
                    out.append((host, f"https://{host}", label))
    return out


def labelled(spark: SparkSession) -> DataFrame:
    """Columns host, url and label."""
    return spark.createDataFrame(rows(), "host string, url string, label double").coalesce(1)
