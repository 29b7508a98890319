"""The refinement jobs, their chaining through zone tables, checks and the registered queries."""
