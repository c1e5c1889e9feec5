"""Where each known source keeps its fields and links."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from shelftrack.sources.page_tree import Field


@dataclass(frozen=True)
class PageRules:
    """Selectors of one source."""

    hosts: tuple[str, ...]
    scope: str
    fields: Mapping[str, Field]
    link_prefix: str | None = None
    links: tuple[tuple[str, str, Field], ...] = ()
    detail_scope: str | None = None
    detail_fields: Mapping[str, Field] = field(default_factory=dict)


# Site markup, as the sites publish it.
SOURCE_RULES = {
    "laguna": PageRules(
        hosts=("laguna.rs", "www.laguna.rs"),
        scope=".//body[@id='knjiga_page']",
        link_prefix="https://www.laguna.rs/",
        fields={
            "title": Field(".//h1[@class='naslov']", element=3, page=True),
            "author": Field(".//h2[1]/a", element=1, page=True),
            "book_link": Field(".//a[@class='komentar-podatak']", take="@href", page=True),
            "category": Field(".//span[@class='naslov_podatka']", beside="h3/a", page=True),
            "old_price": Field(".//div[@class='cena']//span[@class='naslov']", beside="text", nth=1, page=True),
            "discount_price": Field(".//div[@class='cena']//span[@class='naslov']", beside="text", nth=2, page=True),
            "description": Field(".//div[@id='podaci-korica']/div", take="string", nth=0),
        },
        links=(
            ("detail", ".//div[@class='podaci']", Field("./a[1]", take="@href")),
            ("next", ".", Field(".//a", take="@href", css_class="sledeca")),
        ),
    ),
    "mikrok": PageRules(
        hosts=("www.mikroknjiga.rs",),
        scope=".//tr[@class='style_normal']",
        fields={
            "title": Field(".//span[@style='font-size:15px;']"),
            "author": Field(".//td//i"),
            "book_link": Field(".//td//a/span[@style='font-size:15px;']/..", take="@href"),
            "old_price": Field(".//td//strike"),
            "discount_price": Field(".//td//font[@color='#ff00ff']/b"),
        },
        links=(("next", ".", Field(".//*", take="@href", containing="Naredna »")),),
        detail_scope=".",
        detail_fields={
            "description": Field(".//div[@class='prikaz_k2']//span[@class='prikaz_opis']", take="string"),
            "category": Field(".//div[@class='prikaz']/div/a", nth=2),
        },
    ),
    "prometej": PageRules(
        hosts=("prometej.rs",),
        scope=".//div[@id='content']",
        fields={
            "title": Field(".//h1[@class='product_title entry-title']"),
            "author": Field(".//div[@id='content']//span[@itemprop='author']", element=1, page=True),
            "book_link": Field(".//div[@class='book-cover small']/a", take="@href", element=1, page=True),
            "category": Field(".//span[@class='posted_in']/a", page=True),
            "old_price": Field(".//div[@id='content']//del", page=True),
            "discount_price": Field(".//span[@class='sale-price amount']", element=1, page=True),
            "description": Field(".//div[@class='large-6 columns']", take="string", page=True),
        },
        links=(
            (
                "detail",
                ".//div[@class='large-6 medium-4 columns product-listing']//div[@class='book-meta']",
                Field("./a", take="@href", nth=0),
            ),
            ("next", ".", Field(".//a[@class='next page-numbers']", take="@href")),
        ),
    ),
}
