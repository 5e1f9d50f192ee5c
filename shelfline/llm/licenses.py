"""Licence scans: canonical digests of whole texts and of their lines, joined to the digests of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.plans.sizing import join_dim

# Public notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
]
# Digests of whole licence texts in canonical form; some with and without title, closing line or appendix.
TEXTS = [
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("0BSD", "53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe"),
    ("0BSD", "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153"),
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "2c570d136b858b0a4d090e301862eacb53fb1ae2743462bf3b89e602191665f7"),
    ("BSD-2-Clause", "2e9901df2d3cdd9b2ad2d0541a98d0ffe16ec6a54494b7837b493c08b3bde071"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "52708ae7496bad323efc341f2b977f4deecc250729644235974381dbffa10b45"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "e651765ec94c99c2ea03cf19aceb85785d656ba08685eb0772747c296340cb54"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("ISC", "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db"),
    ("ISC", "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "45f871bea213049debb9a6530f956c0a964c3d0ec098d776356257d0059f0900"),
    ("MIT", "46559ac7233556b376cbaed5c820190eaf6a55b1cf4860d0649c94a1a5b46a62"),
    ("MIT", "af1716b199e1387a1d7c9da7d827c72dcc9508ff1be0e437b94dd4141a9a9573"),
    ("MIT", "b394918a083200adf8c5061924bc22de28062756b62d30b8e876d73b78acef8e"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]
# Spellings that count as one.
EQUIVALENTS = [("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"),
               ("favour", "favor"), ("noninfringement", "non infringement"),
               ("copyright owner", "copyright holder"), ("per cent", "percent"), ("whilst", "while")]
COPYRIGHT = r"^\s*(copyright|\(c\)|©)"
#: lines that a whole text may have or lack: who holds the rights since when, but no sentence that begins with the word
HOLDER = r"^\s*((copyright\s*(\(c\)|©|[0-9<\[{])|\(c\)\s*[0-9]{4}|©\s*[0-9]).*|all rights reserved\.?\s*)$"


def known_notices(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in NOTICES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def known_texts(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(name).alias("license"), F.lit(value).alias("_digest")) for name, value in TEXTS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _plain(line: Column) -> Column:
    out = F.concat(F.lit(" "), F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for old, new in EQUIVALENTS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(out)


def canonical_text(text: Column) -> Column:
    """The whole text in the same form, however it is cut into lines; lines that name a holder go."""
    return _plain(F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~F.lower(x).rlike(HOLDER)), " "))


def canonical_lines(text: Column) -> Column:
    """Lines with anything in them: lower case, punctuation as one space, one spelling; copyright lines go."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~F.lower(x).rlike(COPYRIGHT))
    return F.filter(F.transform(lines, _plain), lambda x: x != "")


def digest(canonical: Column) -> Column:
    return F.sha2(F.regexp_replace(canonical, " +", " "), 256)


def scan(docs: DataFrame, known: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, whole_license and licenses (sorted, each once) for each row of ``docs`` (doc_id, text).

    A text is looked up whole and line by line, by the digest of its canonical form; ``known`` has license and text.
    ``texts`` (license, _digest) adds digests of whole licence texts, to which a text is held without its lines' breaks.
    ``whole_license`` is the first by name if several are known by one digest. Null and empty texts have none. Rows
    that repeat a doc_id share what is found in any of them. Rows without a doc_id get no licences.
    Copyright lines alone do not keep a licence from being known. Lines without a match leave the plan before the
    only shuffle, which moves one row per match.
    """
    digests = (known.select("license", digest(F.array_join(canonical_lines(F.col("text")), " ")).alias("_digest"))
               .where("license is not null").distinct())
    if texts is not None:
        digests = digests.union(texts.select("license", F.concat(F.lit("text "), "_digest")))
    lines = F.array_distinct(canonical_lines(F.col("text").cast("string")))
    whole = F.array_join(canonical_lines(F.col("text").cast("string")), " ")
    wholes = [("", whole)] if texts is None else [("", whole), ("text ", canonical_text(F.col("text").cast("string")))]
    units = F.concat(F.array(*[F.struct(F.lit(True).alias("all"), F.lit(of).alias("of"), x.alias("t")) for of, x in wholes]),
                     F.transform(lines, lambda x: F.struct(F.lit(False).alias("all"), F.lit("").alias("of"), x.alias("t"))))
    rows = docs.where("doc_id is not null").select("doc_id", F.explode(units).alias("u")).where("u.t <> ''")
    found = join_dim(rows.select("doc_id", F.col("u.all").alias("all"), F.concat("u.of", digest(F.col("u.t"))).alias("_digest")), digests, "_digest", bound=known)
    by_doc = found.groupBy("doc_id").agg(F.min(F.when(F.col("all"), F.col("license"))).alias("whole_license"),
                                         F.array_sort(F.collect_set("license")).alias("licenses"))
    named = by_doc.withColumnRenamed("doc_id", "_id")
    return docs.select("doc_id").join(named, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "whole_license", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"))
