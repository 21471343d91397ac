"""Term tables of the rules: a table of our own, and tables from files."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

from quarry.operators.tagging import check_terms
from quarry.vocab import DOMAINS, MODALITIES


@dataclass(frozen=True)
class Dictionaries:
    """Value -> terms for domains, modalities and conditions; terms of species; and keywords that count only as they stand.

    ``topics`` are lower-cased keywords of ``topic_source``, each with 'modality' or 'domain' and a value. ``body_parts`` are
    upper-cased keywords of ``part_source``, each with a condition, which count if the text has one of ``mentions``.
    """

    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    modalities: Mapping[str, Sequence[str]] = field(default_factory=dict)
    conditions: Mapping[str, Sequence[str]] = field(default_factory=dict)
    animal: Sequence[str] = ()
    human: Sequence[str] = ()
    topics: Mapping[str, Sequence[str]] = field(default_factory=dict)
    body_parts: Mapping[str, str] = field(default_factory=dict)
    mentions: Sequence[str] = ()
    topic_source: str = "physionet"
    part_source: str = "tcia"

    def check(self, domains: Sequence[str] = DOMAINS, modalities: Sequence[str] = MODALITIES) -> Dictionaries:
        """Itself, if every term can be one and every value is known; else an error."""
        check_terms(self.domains, domains)
        check_terms(self.modalities, modalities)
        check_terms(self.conditions)
        check_terms({"species": [*self.animal, *self.human], "mention": list(self.mentions)})
        for keyword, (kind, value) in self.topics.items():
            if value not in {"domain": domains, "modality": modalities}.get(kind, ()):
                raise ValueError(f"topic {keyword!r}: {kind} {value!r} is not in the vocabulary")
        for part, label in self.body_parts.items():
            if label not in self.conditions:
                raise ValueError(f"body part {part!r}: {label!r} is no condition")
        return self


def load(path: str, domains: Sequence[str] = DOMAINS, modalities: Sequence[str] = MODALITIES) -> Dictionaries:
    """Tables from a JSON object with the fields of ``Dictionaries``; what is absent is empty, what is unknown or malformed an error."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    if unknown := set(data) - {x.name for x in fields(Dictionaries)}:
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    return Dictionaries(**data).check(domains, modalities)


#: Tables of our own, for what records most often speak of; a fuller set is a file.
DEFAULT = Dictionaries(
    domains={
        "neurology": ("neurology", "neurological*", "seizure", "seizures", "dementia", "parkinson's"),
        "psychiatry": ("psychiatry", "psychiatric", "mental health", "depressive*"),
        "cardiology": ("cardiology", "cardiac", "arrhythmia*", "heart disease"),
        "oncology": ("oncology", "cancer", "carcinoma", "tumor", "tumour"),
        "pulmonology": ("pulmonology", "respiratory", "lung disease"),
        "critical_care": ("critical care", "intensive care", "icu"),
        "pediatrics": ("pediatric", "paediatric", "neonatal*"),
        "infectious_disease": ("infectious disease", "covid-19", "sepsis"),
        "endocrinology_metabolism": ("diabetes", "insulin", "obesity"),
        "public_health": ("public health", "epidemiolog*"),
    },
    modalities={
        "MRI": ("mri", "magnetic resonance imaging"),
        "fMRI": ("fmri", "functional mri"),
        "PET": ("positron emission tomograph*",),
        "CT": ("computed tomograph*", "ct scan", "ct scans"),
        "ultrasound": ("ultrasound", "echocardiogra*"),
        "EEG": ("eeg", "electroencephalogra*"),
        "ECG": ("ecg", "electrocardiogra*"),
        "EMG": ("emg", "electromyogra*"),
        "wearable": ("accelerometer", "smartwatch"),
        "genomics": ("whole genome", "exome", "genotyp*"),
        "EHR": ("electronic health record", "electronic health records"),
        "survey": ("questionnaire", "questionnaires"),
    },
    conditions={
        "stroke": ("stroke", "ischemic stroke"),
        "epilepsy": ("epilepsy", "epileptic"),
        "sepsis": ("sepsis", "septic shock"),
        "heart failure": ("heart failure",),
        "atrial fibrillation": ("atrial fibrillation", "afib"),
        "schizophrenia": ("schizophrenia",),
        "alzheimer disease": ("alzheimer's disease", "alzheimer disease"),
        "breast neoplasms": ("breast cancer", "breast carcinoma"),
        "lung neoplasms": ("lung cancer", "lung carcinoma"),
    },
    animal=("mouse", "mice", "rat", "rats", "murine", "zebrafish", "macaque", "macaques"),
    human=("human", "humans", "patient", "patients", "participant", "participants", "volunteers"),
    topics={"ecg": ("modality", "ECG"), "eeg": ("modality", "EEG"), "icu": ("domain", "critical_care"), "sepsis": ("domain", "infectious_disease")},
    body_parts={"BREAST": "breast neoplasms", "LUNG": "lung neoplasms"},
    mentions=("cancer", "carcinoma", "tumor", "neoplasm*"),
).check()
