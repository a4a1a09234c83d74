"""Settings of a whole run."""

from __future__ import annotations

from dataclasses import dataclass, field

# Model names a run knows, and the titles used in result tables.
MODEL_TITLES = {
    "naive_bayes": "Naive Bayes",
    "decision_tree": "Decision Tree",
    "maxent": "Maxent",
    "svm": "SVM",
    "random_forest": "Random Forest",
}


@dataclass
class RunConfig:
    train_path: str
    test_path: str
    results_dir: str
    data_format: str = "csv"
    multi_line: bool = True
    """CSV texts may hold line ends inside quotes. Large files are split between tasks either way; switched off, for files
    known to have no such texts, a file is read once instead of twice."""
    label_type: str = "string"
    text_column: str = "text"
    label_column: str = "label"
    language: str = "turkish"
    custom_stopwords: list[str] = field(default_factory=list)
    fold_stopwords: bool = False
    min_word_length: int = 2
    lemma_path: str | None = None
    feature_method: str = "tfidf"
    max_features: int | None = 5000
    ngram_range: tuple[int, int] = (1, 2)
    models: str = "all"
    model_params: dict[str, dict] = field(default_factory=dict)
    optimize: bool = False
    search_grids: dict[str, dict] = field(default_factory=dict)
    cv: int = 5
    parallelism: int = 4
    learning_curves: bool = True
    curve_sample: int | None = 10_000
    """Training rows that learning curves are drawn on; ``None`` takes all."""
    resume: bool = False
    """Take over every loaded table, text, extractor and model of an earlier run in ``results_dir`` that would come out the same."""
    stale: str = "refuse"
    """What a skipped stage does if its stored result comes from other inputs: ``refuse`` (an error) or ``redo``."""
    skip_preprocessing: bool = False
    skip_feature_extraction: bool = False
    skip_model_training: bool = False
    skip_evaluation: bool = False
    skip_statistics: bool = False

    def model_names(self) -> list[str]:
        """Models to run, from ``all`` or a comma list."""
        if self.models.lower() == "all":
            return list(MODEL_TITLES)
        names = [name.strip().lower() for name in self.models.split(",")]
        for name in names:
            if name not in MODEL_TITLES:
                raise ValueError(f"unknown model '{name}', expected one of {', '.join(MODEL_TITLES)}")
        return names
