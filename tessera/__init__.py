"""tessera: preparing, profiling and scoring labelled tables on Spark.

Every operator takes DataFrames and returns DataFrames. Fitting an operator
runs small aggregate jobs whose results (columns x statistics) come back to
the driver as parameters; applying it is a lazy projection that Catalyst
folds into the surrounding plan.
"""

from tessera.session import get_session, checkpoint_dir  # noqa: F401
from tessera.roles import Roles  # noqa: F401
