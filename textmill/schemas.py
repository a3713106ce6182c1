"""Table schemas of the corpus model, in DDL, and its fixed vocabularies."""

from __future__ import annotations

#: One row per stored, failed or duplicate document.
DOCUMENTS = """
    id string, source_url string, crawl_id string, original_filename string, file_size_bytes bigint, status string,
    error_message string, is_valid_docx boolean, discovered_at timestamp, downloaded_at timestamp, uploaded_at timestamp,
    extracted_at timestamp, word_count int, char_count int, table_count int, image_count int, language string,
    language_confidence float, extraction_error string, embedded_at timestamp, embedding_model string,
    embedding array<float>, cluster_id int, cluster_label string, classified_at timestamp, document_type string,
    document_topic string, classification_confidence float, classification_model string
    """

#: One row per inspected raw object.
CORRECTIONS = """
    raw_id string, corrected_id string, status string, reason string, raw_file_size_bytes bigint,
    corrected_file_size_bytes bigint, correction_type string, inspected_at timestamp, corrected_at timestamp
    """

#: An index pointer into an archive file; every field is a string.
CDX = (
    "url string, mime string, status string, digest string, length string, offset string, filename string"
)

SAMPLE = (
    "id string, source_url string, original_filename string, word_count int, file_size_bytes bigint, language string"
)

LABEL = """
    id string, language string, word_count int, original_filename string, source_url string, document_type string,
    document_topic string, type_confidence double, topic_confidence double, confidence double, reasoning string, model string
    """

TAXONOMY = """
    name string, version string, description string,
    document_types array<struct<id: string, label: string, description: string, examples: array<string>>>,
    topics array<struct<id: string, label: string, description: string>>
    """

#: The parsed answer of a labelling model.
ANSWER = (
    "document_type struct<id: string, confidence: double>, topic struct<id: string, confidence: double>, reasoning string"
)

EXPORT = (
    "id string, filename string, type string, topic string, language string, word_count int, confidence float, url string"
)

# The ids of the two-dimensional taxonomy, in its order, and their labels.
TYPE_LABELS = {
    "legal": "Legal",
    "forms": "Forms",
    "reports": "Reports",
    "policies": "Policies",
    "educational": "Educational",
    "correspondence": "Correspondence",
    "technical": "Technical",
    "administrative": "Administrative",
    "creative": "Creative",
    "reference": "Reference",
}
TOPIC_LABELS = {
    "government": "Government",
    "education": "Education",
    "healthcare": "Healthcare",
    "finance": "Finance",
    "legal_judicial": "Legal / Judicial",
    "technology": "Technology",
    "environment": "Environment",
    "nonprofit": "Nonprofit",
    "general": "General",
}
# Names of language codes.
LANGUAGE_NAMES = {
    "en": "English", "ru": "Russian", "cs": "Czech", "pl": "Polish", "es": "Spanish", "zh": "Chinese", "lt": "Lithuanian",
    "sk": "Slovak", "de": "German", "id": "Indonesian", "fr": "French", "pt": "Portuguese", "ar": "Arabic", "ja": "Japanese",
    "ko": "Korean", "it": "Italian", "sv": "Swedish", "nl": "Dutch", "bg": "Bulgarian", "tr": "Turkish", "vi": "Vietnamese",
    "th": "Thai", "uk": "Ukrainian", "ro": "Romanian", "hu": "Hungarian", "hr": "Croatian", "fi": "Finnish", "da": "Danish",
    "nb": "Norwegian", "el": "Greek", "he": "Hebrew", "hi": "Hindi",
}

TYPES = tuple(TYPE_LABELS)
TOPICS = tuple(TOPIC_LABELS)
