"""quillmine: topic mining over collections of papers, as DataFrame transformations."""
