"""The small labelled URL table of the URL filter: public sites, cities and plain words against the vocabulary of unwanted sites, put together by a seeded rule.

Nothing in it comes from a table that is to be judged: harmless names are those of real sites, cities and common nouns, and words that
look like unwanted ones without being any teach the difference.
"""

from __future__ import annotations

import random
import zlib

#: Sites in public use, for label 0.
SITES = """github.com stackoverflow.com en.wikipedia.org de.wikipedia.org fr.wikipedia.org es.wikipedia.org www.nytimes.com www.bbc.co.uk www.theguardian.com
www.lemonde.fr www.spiegel.de elpais.com www.nature.com www.sciencemag.org arxiv.org www.w3.org www.python.org docs.python.org www.apache.org spark.apache.org www.gnu.org
www.debian.org kernel.org www.mozilla.org developer.mozilla.org www.archive.org www.gutenberg.org www.loc.gov www.nasa.gov www.nih.gov www.cdc.gov www.who.int www.un.org europa.eu
www.mit.edu www.stanford.edu www.harvard.edu www.ox.ac.uk www.cam.ac.uk www.ethz.ch www.tum.de www.reuters.com apnews.com www.npr.org www.pbs.org www.economist.com www.ft.com
www.imdb.com www.goodreads.com www.allrecipes.com www.weather.gov www.openstreetmap.org www.wikidata.org commons.wikimedia.org www.britannica.com www.merriam-webster.com
www.amazon.com www.ebay.com www.etsy.com www.ikea.com www.booking.com www.lonelyplanet.com www.nationalgeographic.com www.smithsonianmag.com www.khanacademy.org www.coursera.org
www.reddit.com news.ycombinator.com medium.com wordpress.org www.linkedin.com www.youtube.com vimeo.com www.flickr.com www.npmjs.com pypi.org crates.io hub.docker.com
www.sueddeutsche.de www.zeit.de www.liberation.fr www.elmundo.es www.corriere.it www.nrc.nl www.svt.se yle.fi www.dr.dk www.nrk.no www.abc.net.au www.cbc.ca www.nzherald.co.nz""".split()

#: Cities and regions, for label 0.
PLACES = """amsterdam antwerp athens auckland barcelona basel belfast bergen berlin bern bilbao birmingham bologna bordeaux boston bratislava bremen brighton bristol brussels bucharest budapest
cairo calgary cambridge canberra cardiff chicago cologne copenhagen cork cracow dallas delhi denver dortmund dresden dublin dundee edinburgh essen florence frankfurt galway geneva genoa ghent
glasgow gothenburg graz grenoble hamburg hanover helsinki houston innsbruck istanbul jakarta kyoto lausanne leeds leicester leiden leipzig lille lima linz lisbon liverpool ljubljana london lucerne
lyon madrid malmo manchester marseille melbourne milan minneapolis montreal munich nairobi nantes naples newcastle nice norwich nottingham oslo ottawa oxford palermo paris perth philadelphia
pittsburgh plymouth porto portland prague quebec reykjavik riga rome rotterdam salzburg santiago seattle seville sheffield sofia stockholm strasbourg stuttgart sydney tallinn tokyo toronto
toulouse trieste turin utrecht valencia vancouver venice vienna vilnius warsaw wellington york zagreb zurich""".split()

#: Plain words of hosts and paths, for either label.
WORDS = """garden river school museum stone bakery library mountain valley harbor village forest market bridge castle island meadow orchard station theatre concert gallery history
science physics biology chemistry geology astronomy medicine nursing law finance travel kitchen recipe bread coffee cheese wine football cycling hiking sailing chess music piano guitar
painting poetry novel review report letter journal archive weekly daily local city town county national world health family children teacher student research project software
network server database compiler editor manual guide tutorial course lecture forum photo camera film radio podcast blog news press weather calendar event""".split()

#: Words that look like those of label 1 and are none, for label 0.
LOOKALIKES = """essex sussex middlesex sextant bisexual-history alphabet better betty diabetes beta winchester windsor winery winston winter freedom freeman freeport freedive hotel hotspur photonics
cheapside cheaptickets cheaprail adulteducation adulthood youngadultbooks topology topeka biggin bigben crackers nutcracker crackle firecracker cracks-in-concrete poke-bowl pokedex spokes
spokesman casinoroyale-film casino-architecture loanword library-loans interlibraryloan buyersguide clicker lottery-history realestate realist vipers primegrid slotcar timeslots pillar pillow
caterpillar megalith megaphone dating-fossils carbon-dating escortwagon keyboard keynote bonusmaterial torrentialrain camshaft webcams-birds replicator dickens scunthorpe cockpit assessment
analytics titanic milford nudibranch""".split()

#: Words that speak for label 1.
UNWANTED = """casino poker slots roulette blackjack jackpot betting sportsbet bookmaker lottery sweepstakes viagra cialis levitra pills steroids tramadol xanax weightloss dietpill
replica rolex-replica fake-watches payday loans quickcash easymoney getrich binaryoptions cryptodoubler freebitcoin airdrop porn xxx sex adult cams livecams escort escorts nude hookup milf erotic
crack keygen warez serials nulled torrents seolinks backlinks buyfollowers freebonus winprize claimprize giftcards freeiphone miraclecure enlargement onlinepharmacy essaywriting clickhere""".split()

BOOSTS = "cheap best online free hot top buy win real big vip 24 365 super mega instant now 4u".split()
DOMAINS = "com com com org org net edu gov info co.uk org.uk ac.uk de fr es it nl ch at ca com.au eu io".split()
UNWANTED_DOMAINS = "com com com net org info biz top xyz online club site win bet loan click ru".split()


def plain_path(r: random.Random) -> str:
    w, n = lambda: r.choice(WORDS), r.randint(1, 20_000)
    return r.choice(
        ["", "/", "", "/", f"/wiki/{w().title()}", f"/questions/{n}/{w()}-{w()}-{w()}", f"/{r.randint(2001, 2024)}/0{r.randint(1, 9)}/{w()}-{w()}", f"/article/{n}", f"/docs/{w()}", "/about", "/contact", f"/{w()}", f"/{w()}/{w()}",
         f"/{w()}/{n}", f"/index.php?id={n}", f"/p/{n}", f"/category/{w()}", f"/{r.choice(PLACES)}/{w()}", f"/{r.choice(LOOKALIKES)}"]
    )


def unwanted_path(r: random.Random) -> str:
    s, n = lambda: r.choice(UNWANTED), r.randint(1, 20_000)
    return r.choice([f"/{s()}", f"/{r.choice(BOOSTS)}-{s()}", f"/{s()}/{s()}?aff={n}", f"/buynow/{s()}?id={n}", f"/bonus/{n}", f"/{s()}-{s()}-{r.choice(BOOSTS)}", f"/click/{s()}/{n}"])


def harmless(r: random.Random) -> str:
    w, place, like = r.choice(WORDS), r.choice(PLACES), r.choice(LOOKALIKES)
    name = r.choice([w, f"{w}{r.choice(['-', ''])}{r.choice(WORDS)}", place, f"{place}{r.choice(['-', ''])}{w}", f"{w}{r.choice(['-', '', '-in-'])}{place}", like, like, f"{like}-{r.choice([w, place])}"])
    host = r.choice([r.choice(SITES), *[f"{r.choice(['www.', 'news.', 'docs.', 'shop.', '', ''])}{name}.{r.choice(DOMAINS)}"] * 4])
    return f"{r.choice(['https', 'https', 'http'])}://{host}{plain_path(r)}"


def unwanted(r: random.Random) -> str:
    s, b, w = r.choice(UNWANTED), r.choice(BOOSTS), r.choice(WORDS)
    name = r.choice([s, f"{s}-{b}", f"{b}-{s}", f"{b}{s}", f"{s}{b}", f"{s}{r.randint(1, 999)}", f"{s}-{r.choice(UNWANTED)}", f"{s}{r.choice(UNWANTED)}", f"{s}-{w}", f"{w}-{s}", f"{s}.{r.choice(PLACES)}"])
    if r.random() < 0.12:  # a harmless host that was made to carry something else
        return f"http://{r.choice(['www.', ''])}{r.choice([r.choice(PLACES), w])}.{r.choice(DOMAINS)}{unwanted_path(r)}"
    return f"{r.choice(['http', 'https'])}://{r.choice(['www.', 'get.', '', ''])}{name}.{r.choice(UNWANTED_DOMAINS)}{r.choice([plain_path, unwanted_path])(r)}"


def labelled_urls(each: int = 3000, seed: int = 41) -> list[tuple[str, int]]:
    """Distinct (url, 1 for block), ``each`` of either label at most, and URLs without host or path, for which nothing speaks."""
    r = random.Random(seed)
    return sorted({(harmless(r), 0) for _ in range(each)} | {(unwanted(r), 1) for _ in range(each)} | {("", 0), ("no-scheme", 0)})


def held_out(url: str) -> bool:
    """One URL in five is never trained on."""
    return zlib.crc32(url.encode()) % 5 == 0
