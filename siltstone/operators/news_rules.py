"""The rule pack for Chinese news pages. All lists here are fixed values: results depend on each entry."""

from __future__ import annotations

# Markers that end an article wherever they stand in a line.
STRONG_ENDS = [
    "不用抽 不用搶",
    "不用抽不用搶",
    "點我下載APP",
    "按我活動辦法",
    "上一則",
    "下一則",
    "此網頁已閒置",
    "```json",
    "```JSON",
    '{"@context"',
    '{"@type"',
    "（相關報導：",
    "（相關報導:",
    "張貼文章或下標籤",
    "### ‧",
    "今日排行榜",
    "往下看更多",
    "廣告 / 請繼續往下閱讀",
    "## 書籍介紹",
    "責任編輯：",
    "責任編輯:",
    "核稿編輯：",
    "核稿編輯:",
    "封面示意圖",
    "## 熱門新聞",
    "## 專題報導",
    "※本文版權所有",
    "更多CNEWS",
    "更多匯流新聞網報導",
    "All rights Reserved",
    "All Rights Reserved",
    "收看中視新聞",
    "請鎖定新聞台",
    "新聞授權",
    "經授權轉載",
    "文章轉載請註明出處",
    "延伸閱讀",
    "深度求真",
    "訂閱中視新聞",
]

# Markers that end an article on a short line.
WEAK_ENDS = [
    "今日熱門",
    "熱門新訊",
    "熱門新聞",
    "大家都關注",
    "看更多！請加入",
    "看更多!請加入",
    "推薦閱讀",
    "你可能也想看",
    "更多新聞",
    "相關報導",
    "相關新聞",
    "則留言",
    "[發布]",
    "政治熱門新聞",
    "讀者迴響",
    "最夯影音",
    "熱門快報",
    "更多熱門",
    "關鍵字：",
    "關鍵字:",
]

# Markers that cut what is left after the line rules.
LATE_ENDS = [
    "```json",
    '{"@context"',
    '{"@type"',
    "登入裝置已達上限",
    "親愛的會員",
    "請您暫停使用AD Block",
    "### VIP",
    "### 財訊快報",
    "### 編輯精選",
    "### FB 粉絲團",
    "付費訂閱",
    "參與議題",
    "你認同本文的觀點嗎",
    "收藏文章",
    "AD Block",
    "本網站之文字、圖片及影音",
    "點我訂閱",
    "一手掌握經濟脈動",
    "到您有啟用",
    "我們偵測",
    "更多風傳媒獨家內幕",
    "張貼文章或下標籤",
    "則留言",
    "科技新知，時時更新",
    "關鍵字:",
    "留給我們的話",
    "請喝咖啡",
    "總金額共新臺幣",
    "咖啡贊助",
    "每杯咖啡",
    "想請我們喝",
    "### ‧",
    "今日排行榜",
    "往下看更多",
    "## 書籍介紹",
    "責任編輯：",
    "責任編輯:",
    "核稿編輯：",
    "核稿編輯:",
    "廣告 / 請繼續往下閱讀",
    "## 相關新聞",
    "## 相關報導",
    "## #",
    "封面示意圖",
    "政治熱門新聞",
    "讀者迴響",
    "最夯影音",
    "更多熱門",
    "熱門快報",
    "## 熱門新聞",
    "## 專題報導",
    "※本文版權所有",
    "更多CNEWS",
    "更多匯流新聞網報導",
    "All rights Reserved",
    "All Rights Reserved",
    "收看中視新聞",
    "請鎖定新聞台",
    "新聞授權",
    "經授權轉載",
    "文章轉載請註明出處",
    "延伸閱讀",
    "深度求真",
    "訂閱中視新聞",
]

# Patterns of lines that are dropped, searched in the stripped line.
NOISE = [
    r"^\[\s*\]\(.*?\)\s*$",
    r"^\s*\[.*?\]\(https?://.*?\)\s*$",
    r"^\*\s+\[.*?\]\(.*?\)\s*$",
    r"^\s*\[.*?\]\(/author/.*?\)\s*$",
    r"^\s*(\[.*?\]\(/author/\d+\)\s*)+",
    r"請繼續往下閱讀",
    r"pv\d+\.\w+\.com\.tw/click",
    r"javascript:\s*void",
    r"加入.*會員",
    r"按讚收藏",
    r"登入會員",
    r"下次再說",
    r"訂閱.*會員",
    r"訂閱.*VIP",
    r"零廣告閱讀",
    r"^顯示全部$",
    r"^我們想讓你知道的是$",
    r"您即將進入之新聞內容",
    r"電腦網路內容分級處理辦法",
    r"台灣網站分級推廣基金會",
    r"未滿18歲",
    r"我同意.*已年滿",
    r"此篇文章含有成人內容",
    r"我已滿 18 歲",
    r"我未滿 18 歲",
    r"禁止酒駕",
    r"未滿十八歲禁止飲酒",
    r"中央通訊社是中華民國的國家通訊社",
    r"^#{6}\s",
    r"^#{2,4}\s*\[.*?\]\(.*?\)",
    r"^#{2,4}\s*\[.*?\]\(#\)",
    r"\[首頁\].*?\\>",
    r"對於明知不實",
    r"凡「暱稱」涉及",
    r"不同意上述規範者",
    r"^More$",
    r"^收藏文章$",
    r"本網站之文字、圖片及影音.*不得轉載",
    r"點我訂閱.*頻道",
    r"^\*\s*\.\.\.\s*$",
    r"^\*{3,}‧?\s*\[",
    r"^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}\s*$",
    r"^Share\s*:\s*\[",
    r"^Photo Credit:",
    r"^圖片來自",
    r"^▼",
    r"^（封面",
    r"^（圖[/／╱]",
    r"透過以上連結購書",
    r"導購分潤收入",
    r"獲得分潤收益",
    r"^TNL精選書籍",
    r"^[A-Za-z\u4e00-\u9fff]{1,4}[/／]\s*編輯\s*$",
    r"^##\s+#",
    r"^\[來就送",
    r"^\[首頁\]\(/",
    r"^分享\s+分享\s+複製連結",
    r"^聽新聞$",
    r"^發布時間：\d{4}",
    r"^更新時間：\d{4}",
    r"^發布時間：.*更新時間：",
    r"^※",
    r"All [Rr]ights [Rr]eserved",
    r"^更多CNEWS",
    r"^更多匯流新聞網",
    r"收看中視新聞",
    r"請鎖定新聞台",
    r"^【[^】]*授權[^】]*】",
    r"新聞授權",
    r"^Fill 1$",
    r"^Fill$",
    r"^（攝影",
    r"^（繪圖",
    r"^\s*\[[^\]]{2,8}\](\([^\)]*\))?\s*$",
    r"^## 書評$",
]

# Categories in the order of a classifier's outputs, and those kept by default.
CATEGORIES = ["政治", "科技", "運動", "證券", "產經", "娛樂", "生活", "國際", "社會", "文化", "兩岸"]
KEPT_CATEGORIES = ["政治", "國際", "兩岸", "社會"]

# API names of source keys.
SOURCE_NAMES = {
    "LIBERTY_TIMES": "自由時報",
    "CHINA_TIMES": "中國時報",
    "UNITED_DAILY_NEWS": "聯合報",
    "COMMON_WEALTH": "天下雜誌",
    "BUSINESS_WEEKLY": "商業週刊",
    "THE_NEWS_LENS": "關鍵評論網",
    "THE_REPORTER": "報導者",
    "CNA": "中央社",
    "PTS": "公視新聞",
    "ECONOMIC_DAILY_NEWS": "經濟日報",
    "COMMERCIAL_TIMES": "工商時報",
    "INSIDE": "Inside",
    "TECHNEWS": "科技新報",
    "ITHOME": "iThome",
    "STORM_MEDIA": "風傳媒",
    "ETTODAY": "ETtoday新聞雲",
    "SETN": "三立新聞",
    "EBC": "東森新聞",
    "NEWTALK": "新頭殼",
    "MIRROR_MEDIA": "鏡週刊",
    "CNEWS": "匯流新聞",
    "TTV": "台視新聞",
    "CTV": "中視新聞",
    "CTS": "華視新聞",
}
