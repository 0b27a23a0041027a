"""Fixed values that must equal the reference's for the same results.

FIXED VALUES (taken from the reference's job wiring, stated as plain text):
  popularity window: 60 minutes long, sliding every 80 seconds, top 17 items
  history window: 60 seconds long, sliding every 20 seconds, 10 items kept
  history watermark bound: 10 seconds out of order; popularity: ascending (0 s)
  recommendations per user: 8
  wire line: "user,item,time" joined with ","; topic key "news"
  time format: "yyyy-MM-dd HH:mm:ss"
  constrained-policy perturbation scale: 0.05; latent noise clamp: [-0.5, 0.5];
  latent size = 2 x action size
  scoring algorithms: "ddpg", "reinforce", "bcq"
"""

POP_WINDOW = "60 minutes"
POP_SLIDE = "80 seconds"
POP_WINDOW_SEC = 3600
POP_SLIDE_SEC = 80
TOP_N = 17

HIST_WINDOW = "60 seconds"
HIST_SLIDE = "20 seconds"
HIST_WINDOW_SEC = 60
HIST_SLIDE_SEC = 20
HIST_LEN = 10
HIST_LATENESS = "10 seconds"
POP_LATENESS = "0 seconds"

N_REC = 8

WIRE_SEP = ","
WIRE_KEY = "news"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

BCQ_PHI = 0.05
BCQ_Z_CLAMP = 0.5

ALGOS = ("ddpg", "reinforce", "bcq")
