"""Training-data operators: filters, tokenizers, archives, models and similarity joins over documents, pages and vectors."""
