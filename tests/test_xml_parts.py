"""Parts of XML tags: attributes once each, the last of a name; texts that hold ">"."""

from pyspark.sql import functions as F

from sitecorpus.sources import design_xml


def test_attributes_are_found_once_per_tag_and_the_last_of_a_name_counts(spark):
    made = spark.createDataFrame([(""" x="1" y='a &lt; "b"' bare u=5 x="2" z="" /""",)], "attrs string").select(design_xml.attribute_map(F.col("attrs")).alias("m"))
    assert made.first().m == {"x": "2", "y": 'a < "b"', "bare": "true", "5": "true", "z": ""}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_tags_are_cut_after_their_own_end(spark):
    docs = spark.createDataFrame([(1, """<a x="1>2">one > two &amp;\n three<b-c:d/><e y='"'/></a > end""")], "page_id bigint, xml string")
    got = [(r.kind, r.tag, r.attrs, r.text) for r in design_xml.xml_tokens(docs).orderBy("pos").collect()]
    assert got == [("open", "a", ' x="1>2"', "one > two & three"), ("self", "b-c:d", "/", ""), ("self", "e", """ y='"'/""", ""), ("close", "a", " ", "end")]
