"""Jobs: operators in their order, with the side effects of each step."""
