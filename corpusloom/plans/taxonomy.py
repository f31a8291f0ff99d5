"""The taxonomy: domains, the coarse labels they claim, and how labels are routed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: The 26 labels of the coarse classifier.
COARSE_LABELS = ("Adult", "Arts_and_Entertainment", "Autos_and_Vehicles", "Beauty_and_Fitness", "Books_and_Literature", "Business_and_Industrial", "Computers_and_Electronics", "Finance", "Food_and_Drink", "Games", "Health", "Hobbies_and_Leisure", "Home_and_Garden", "Internet_and_Telecom", "Jobs_and_Education", "Law_and_Government", "News", "Online_Communities", "People_and_Society", "Pets_and_Animals", "Real_Estate", "Science", "Sensitive_Subjects", "Shopping", "Sports", "Travel_and_Transportation")


class TaxonomyError(ValueError):
    """The taxonomy contradicts itself."""


@dataclass(frozen=True)
class Domain:
    """description: for the teacher's prompt. whole: labels claimed outright. partial: labels shared with ordinary prose. probe: keywords."""

    name: str
    description: str
    whole: tuple[str, ...] = ()
    partial: tuple[str, ...] = ()
    probe: tuple[str, ...] = ()


@dataclass(frozen=True)
class Taxonomy:
    domains: tuple[Domain, ...]
    fallback: str
    labels: tuple[str, ...] = field(default=COARSE_LABELS)

    def __post_init__(self) -> None:
        names = [d.name for d in self.domains]
        if len(names) < 2:
            raise TaxonomyError("at least two domains are needed")
        if len(set(names)) < len(names):
            raise TaxonomyError("domain names must be distinct")
        if self.fallback not in names:
            raise TaxonomyError(f"the fallback {self.fallback!r} is no domain")
        for d in self.domains:
            if not d.description.strip():
                raise TaxonomyError(f"{d.name} has no description")
            if d.name == self.fallback and (d.whole or d.partial):
                raise TaxonomyError(f"the fallback {d.name} must claim no label")

    @property
    def names(self) -> list[str]:
        return [d.name for d in self.domains]

    @property
    def probes(self) -> dict[str, tuple[str, ...]]:
        return {d.name: d.probe for d in self.domains if d.probe}

    def claims(self) -> dict[str, list[str]]:
        """label -> the domains that claim it, in taxonomy order."""
        out: dict[str, list[str]] = {}
        for d in self.domains:
            for label in (*d.whole, *d.partial):
                out.setdefault(label, []).append(d.name)
        return out

    def label_probes(self) -> dict[str, tuple[str, ...]]:
        """A domain's first label -> the keywords of all domains of which it is the first, each once.

        Keywords can't tell the labels of one domain apart: with the same keywords for each, they would share its score.
        """
        out: dict[str, dict[str, None]] = {}
        for d in self.domains:
            for label in (*d.whole, *d.partial)[:1]:
                out.setdefault(label, {}).update(dict.fromkeys(d.probe))
        return {label: tuple(words) for label, words in out.items() if words}

    def direct(self) -> dict[str, str]:
        """Labels that one domain alone claims outright, and that domain."""
        shared = {x for d in self.domains for x in d.partial}
        return {label: who[0] for label, who in self.claims().items() if len(who) == 1 and label not in shared}

    def ambiguous(self) -> list[str]:
        """Claimed labels that need a second stage: contested or partial, in alphabetical order."""
        direct = self.direct()
        return sorted(label for label in self.claims() if label not in direct)

    def prompt(self, slot: str = "{sent}") -> str:
        """The teacher's instruction (its wording is a fixed value), with a slot for the sentence."""
        listed = "\n".join(f"- {d.name}: {d.description}" for d in self.domains)
        return f"Classify this English sentence into exactly one domain.\n\n{listed}\n\nReply with only the domain name, nothing else.\nSentence: {slot}"

    def routing_rows(self) -> list[tuple[str, str, str | None, str]]:
        """label, outcome, domain (null if stage 2 decides), claimed_by: for every known or claimed label."""
        direct, claims = self.direct(), self.claims()
        rows = []
        for label in sorted({*self.labels, *claims}):
            outcome = "direct" if label in direct else "ambiguous" if label in claims else "general"
            domain = direct.get(label) if outcome == "direct" else self.fallback if outcome == "general" else None
            rows.append((label, outcome, domain, "/".join(claims.get(label, []))))
        return rows

    def routing_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.routing_rows(), "label string, outcome string, domain string, claimed_by string")

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(d.name, i, d.description, list(d.whole), list(d.partial), list(d.probe)) for i, d in enumerate(self.domains)]
        return spark.createDataFrame(rows, "domain string, ordinal int, description string, whole array<string>, partial array<string>, probe array<string>")


#: The production taxonomy.
PRODUCTION = Taxonomy(
    (
        Domain("Tech", "computing, software, electronics, telecom, the internet", ("Computers_and_Electronics", "Internet_and_Telecom"), (), ("software", "computer", "internet", "digital", "network")),
        Domain("Agriculture", "farming, crops, livestock, irrigation, food production", (), ("Business_and_Industrial", "Food_and_Drink"), ("farm", "crop", "irrigat", "livestock", "harvest", "soil")),
        Domain("Climate", "weather, environment, climate change, natural disasters", (), ("Science",), ("climate", "monsoon", "rainfall", "glacier", "emission")),
        Domain("Tourism", "travel, hospitality, destinations, heritage sites, trekking", (), ("Travel_and_Transportation",), ("tourist", "trek", "hotel", "heritage", "travel")),
        Domain("Admin", "government administration and public services - an office issuing, registering, applying or announcing something", ("Law_and_Government",), (), ("committee", "ministry", "notice", "department", "applicant")),
        Domain("Health", "medicine, disease, treatment, hospitals, public health", ("Health",), (), ("patient", "disease", "vaccine", "hospital", "symptom")),
        Domain("Law", "legislation, courts and legal process - a statute, a case, a judgment, a legal right or obligation", ("Law_and_Government",), (), ("court", "act ", "clause", "petition", "tribunal")),
        Domain("Education", "schooling, teaching, curriculum, examinations, academia", ("Jobs_and_Education",), (), ("student", "curriculum", "school", "examination", "teacher")),
        Domain("General", "everything else - ordinary prose that fits no domain above"),
    ),
    fallback="General",
)

#: Keywords that look for rows a domain may have missed.
RECALL_PROBES = {
    "Climate": ("climate", "monsoon", "rainfall", "glacier", "emission", "drought", "flood"),
    "Agriculture": ("farm", "crop", "irrigat", "livestock", "harvest", "soil", "fertilis", "fertiliz"),
    "Tourism": ("tourist", "trek", "hotel", "heritage", "lakeside", "homestay"),
    "Law": ("court", "tribunal", "petition", "clause", "verdict"),
    "Admin": ("ministry", "committee", "district office", "applicant", "notice"),
}

#: Labels of the stand-in scorer over the synthetic tables, each defined by a fragment that occurs there.
SYNTHETIC_LABELS = {"c_copy": "copyright|license", "c_edst": "edst", "c_eren": "eren", "c_ering": "ering", "c_hah": "hah", "c_ndst": "ndst", "c_ness": "ness", "c_shwh": "shwh", "c_thre": "thre", "c_vile": "worthless|garbage|stupid"}

#: A taxonomy of the same shape over those labels.
SYNTHETIC = Taxonomy(
    (
        Domain("Alpha", "lines about ering", ("c_ering",), (), ("ering", "inger")),
        Domain("Beta", "lines about hah", ("c_hah",), (), ("haha", "hahe")),
        Domain("Gamma", "vile lines", ("c_vile",), (), ("worthless", "garbage", "stupid")),
        Domain("Delta", "licences", ("c_copy",), (), ("copyright", "license")),
        Domain("Epsilon", "lines about edst", (), ("c_edst",), ("edst", "sted")),
        Domain("Zeta", "lines about ndst", (), ("c_ndst",), ("ndst", "stnd")),
        Domain("Eta", "lines about shwh", ("c_shwh",), (), ("shwh",)),
        Domain("Theta", "lines about shwh or ness", ("c_shwh",), ("c_ness",), ("ness", "whsh")),
        Domain("Other", "everything else"),
    ),
    fallback="Other",
    labels=(*SYNTHETIC_LABELS, "c_none"),
)

#: Recall probes over the synthetic tables.
SYNTHETIC_RECALL = {"Epsilon": ("edst", "sted"), "Zeta": ("ndst", "stnd"), "Eta": ("shwh", "whsh"), "Gamma": ("worthless", "stupid", "idiot"), "Delta": ("license", "reserved")}
