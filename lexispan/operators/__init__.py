"""Table-in/table-out operators: chunking, index, search, context, evaluation."""
