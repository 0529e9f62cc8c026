"""cartulary: a PySpark engine for document, question-answer and training-corpus work."""
