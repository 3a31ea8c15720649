"""Plans: silver build, dimensions, fact, checks, reports, materialisation, the whole flow."""
