"""Galleries in long form: one row per image from the start, for pages whose images do not fit one row.

``records.gallery`` sorts a page's own array. Here an image is a row of a table, the first of each
address wins in an aggregate, and places are counted in blocks of positions, so that no
task holds a page. Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions import ids
from excursio.functions.sql import Sql, coalesce, each, null, quote, struct
from excursio.functions.text import clean, fallback, prefix
from excursio.operators.images import usable
from excursio.operators.linkage import join_children
from excursio.operators.records import FULL, prepare
from excursio.settings import GALLERY_JUNK, Settings
from excursio.sources.scratch import kept

#: Kind of an image by its part: cover, hero image, hero images, page gallery.
KINDS = ("cover", "hero", "hero_gallery", "gallery")
#: Positions in a block.
BLOCK = 10_000
_OF_IMAGE = ("url", "alt", "title", "caption", "type")


def page_facts(raw: DataFrame, settings: Settings = Settings(), custom_id: Sql | None = None) -> DataFrame:
    """What the images of a page share: one narrow row per raw record."""
    tags = f"filter(array({clean('hero.category')}, {clean('hero.city')}), t -> t <> '')"
    return prepare(raw, settings, custom_id).select(
        "page_id", F.expr(ids.gallery_base("_key")).alias("base"), F.col("_id").alias("activity_id"), F.col("_shown").alias("shown"),
        F.expr(tags).alias("tags"), F.expr(clean(fallback("seo.title", "_shown"))).alias("meta_title"),
        F.expr(clean(fallback("seo.metaDescription", prefix(FULL, 160)))).alias("meta_description"), F.col("_now").alias("now"))


def page_images(raw: DataFrame) -> DataFrame:
    """The images of raw records, in long form: page_id, part, pos, url, alt, title, caption, type."""
    def image(part: int, pos: Sql, url: Sql, **rest: Sql) -> Sql:
        return struct(part=str(part), pos=f"CAST({pos} AS BIGINT)", url=url, **{c: rest.get(c, null("STRING")) for c in _OF_IMAGE[1:]})

    def listed(part: int, images: Sql) -> Sql:
        every = each(images, lambda x, i: image(part, i, **{c: f"{x}.{c}" for c in _OF_IMAGE}))
        # a missing image in the list has no address
        return coalesce(every, "array()")

    leads = f"array({image(0, '0', 'hero.coverImage')}, {image(1, '0', 'hero.heroImage')})"
    images = f"concat({leads}, {listed(2, 'hero.images')}, {listed(3, 'gallery')})"
    return raw.select("page_id", F.explode(F.expr(images)).alias("i")).select("page_id", "i.*")


def ranked_images(images: DataFrame, block: int = BLOCK) -> DataFrame:
    """The images that stay, first of each address on its page, with their place among them from 1.

    Rows without address, drawings and icons go. Repeated rows count once; of two images at the same place
    the lesser address comes first. Addresses combine before the shuffle, and a page counts as many
    rows as it has blocks of positions, so no task holds more of it than a block.
    """
    rest = F.struct("part", "pos", "alt", "title", "caption", "type")
    first = images.where(F.expr(usable("url", GALLERY_JUNK))).groupBy("page_id", "url").agg(F.min(rest).alias("i"))
    first = kept(first.select("page_id", "url", "i.*", F.floor(F.col("i.pos") / block).alias("block")), "images")
    at = ["page_id", "part", "block"]
    counts = first.groupBy(*at).agg(F.count("*").alias("n"))
    own = F.expr("sum(n) OVER (PARTITION BY page_id ORDER BY part, block ROWS UNBOUNDED PRECEDING) - n")
    numbered = first.withColumn("rank", F.expr("row_number() OVER (PARTITION BY page_id, part, block ORDER BY pos, url)"))
    joined = numbered.alias("a").join(
        counts.select(*at, own.alias("before")).alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in at])
    return joined.select("a.page_id", "a.part", *[f"a.{c}" for c in _OF_IMAGE], (F.col("a.rank") + F.col("b.before")).alias("rank"))


def gallery_of(images: DataFrame, pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Gallery records of images in long form, as ``records.gallery`` gives them.

    images: as ``page_images`` gives them; pages: as ``page_facts`` does. Images of no page are left out.
    """
    ranked = ranked_images(images, block)
    rows = join_children(pages, kept(ranked, "ranked"), ["page_id"], F.col("rank"))
    lead = "CASE part WHEN 0 THEN concat(shown, ' - Cover') WHEN 1 THEN concat(shown, ' - Hero') ELSE alt END"
    rows = rows.withColumn("_alt", F.expr(lead))
    rows = rows.withColumns({
        "_label": F.expr(clean(fallback("_alt", "title", "caption", "shown"))), "_caption": F.expr(clean(fallback("caption", "_alt")))})
    kind = "CASE part " + " ".join(f"WHEN {k} THEN {quote(v)}" for k, v in enumerate(KINDS)) + " END"
    fields = {
        "id": "base + rank", "activity_id": "activity_id", "url": "url", "title": fallback("_label", "shown"),
        "description": fallback("_caption", "_label", "shown"), "tags": "tags", "meta_title": "meta_title", "meta_description": "meta_description",
        "type": fallback("type", kind), "order": "rank", "created_at": "now", "updated_at": "now"}
    return rows.select("page_id", *[F.expr(e).alias(n) for n, e in fields.items()])
