"""The models, the dashboard queries and the end-to-end build."""
